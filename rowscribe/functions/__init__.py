from rowscribe.functions.values import (
    default_if_falsy,
    joined_names,
    literal_names,
    py_str,
    truthy,
)

__all__ = ["default_if_falsy", "joined_names", "literal_names", "py_str", "truthy"]

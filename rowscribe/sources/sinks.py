"""Write finished training sets."""

import re
from collections.abc import Sequence
from os.path import abspath
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowscribe.operators.columns import quoted


def write_rows(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Write as laid out, in place of what is there. Batched rows are laid out in order
    already. Writing where the rows are read from would destroy them and is refused."""
    # A path without a scheme or a leading slash is one of the working folder, if anything.
    folder = _plain(path if re.match("[A-Za-z][A-Za-z0-9+.-]*:|/", path) else abspath(path))
    if any(file == folder or file.startswith(f"{folder}/") for file in map(_plain, df.inputFiles())):
        raise ValueError(f"the rows to be written to {path!r} are read from it")
    df.write.mode("overwrite").format(format).save(path)


def _plain(path: str) -> str:
    """A path without a scheme, doubled slashes and one at the end, percent signs resolved."""
    return re.sub("/+", "/", "/" + re.sub("^[A-Za-z][A-Za-z0-9+.-]*:", "", unquote(path))).rstrip("/")


def write_sorted(
    df: DataFrame, path: str, keys: Sequence[str], files: int, format: str = "parquet"
) -> None:
    """Write ``files`` files, each holding a sorted range of the keys."""
    columns = [F.col(quoted(key)) for key in keys]
    write_rows(
        df.repartitionByRange(files, *columns).sortWithinPartitions(*columns), path, format
    )


def dry_run(df: DataFrame) -> None:
    """Compute every row and column, and write nothing."""
    df.write.format("noop").mode("overwrite").save()

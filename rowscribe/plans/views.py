"""The training shapes used by the registered queries, out of the given tables."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Turn numbers that are put in order together by :func:`pairs`.
TURNS_PER_BLOCK = 1024


def pairs(turns: DataFrame, turns_per_block: int = TURNS_PER_BLOCK) -> DataFrame:
    """Each user turn with the assistant turn after it, and the chat's system
    turn as input.

    Long chats are cut into blocks of turn numbers, so no task gets a whole one.
    The first turn of a block is also sent to the last block before it that has
    turns, as the answer to its last turn; so gaps in the numbers do no harm.
    """
    of_block = ["conv_id", "block"]
    # System texts come by the join below, so they stay out of the wide shuffle.
    rows = turns.select(
        "conv_id",
        "turn",
        "role",
        F.when(F.col("role") != "system", F.col("text")).alias("text"),
        F.expr(f"turn div {turns_per_block}").alias("block"),
        F.lit(True).alias("own"),
    )
    chat = Window.partitionBy("conv_id")
    blocks = (
        turns.groupBy("conv_id", F.expr(f"turn div {turns_per_block}").alias("block"))
        .agg(
            F.min_by(
                F.struct(
                    "turn", "role", F.when(F.col("role") != "system", F.col("text")).alias("text")
                ),
                "turn",
            ).alias("first"),
            F.max(F.when(F.col("role") == "system", F.col("text"))).alias("system"),
        )
        .select(
            *of_block,
            "first",
            F.lag("block").over(chat.orderBy("block")).alias("before"),
            F.max("system").over(chat).alias("input"),
        )
    )
    carried = blocks.where(F.col("before").isNotNull()).select(
        "conv_id", "first.*", F.col("before").alias("block"), F.lit(False).alias("own")
    )
    following = Window.partitionBy(*of_block).orderBy("turn")
    return (
        rows.union(carried)
        .withColumns(
            {
                "output": F.lead("text").over(following),
                "answered_by": F.lead("role").over(following),
            }
        )
        .where(F.col("own") & (F.col("role") == "user") & (F.col("answered_by") == "assistant"))
        .join(blocks.select(*of_block, "input"), of_block)
        .select("conv_id", "turn", F.col("text").alias("instruction"), "output", "input")
    )


def movies(part: DataFrame) -> DataFrame:
    """Parts as movies: taglines null, empty and present, some overviews empty,
    some genres unreadable."""
    return part.selectExpr(
        "p_partkey as id",
        "p_name as title",
        "case p_size % 3 when 0 then null when 1 then '' else p_brand end as tagline",
        "if(p_size % 5 = 0, '', concat('About ', p_name)) as overview",
        """if(p_size % 7 = 0, 'nan',
              concat("[{'id': ", p_size, ", 'name': '", p_type, "'}, {'id': 1, 'name': '", p_brand, "'}]")
           ) as genres""",
        """if(p_size % 4 = 0, '[]', concat("[{'id': 2, 'name': '", p_name, "'}]")) as keywords""",
        "p_retailprice as vote_average",
        "cast(p_size as bigint) as vote_count",
        "p_retailprice / 100 as popularity",
        "'2001-01-01' as release_date",
        "cast(p_size as double) as runtime",
    )


def train_log(events: DataFrame) -> DataFrame:
    """Events as log records; errors have no loss."""
    return events.select(
        F.col("event_id").alias("step"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("loss"),
    )

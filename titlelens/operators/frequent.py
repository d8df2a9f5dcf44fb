"""Most frequent tokens of a column with very many different ones, exactly.

Counting every token shuffles one row per token and task.  Here a first pass keeps a sketch of
frequent items per task, which is all that is shuffled; a second one counts only its candidates,
again some rows a task.  The sketch's own error bound then tells whether any token outside the
candidates could be among the first `n`.  If one could, all tokens are counted after all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlelens.functions.tokens import explode_tokens
from titlelens.operators.rollup import token_counts

# Items the sketch tracks.  Its counts are too high by at most this share of all tokens, which is
# the sketch's published bound for that size.
TRACKED = 8192
ERROR_SHARE = 3.5 / TRACKED
CANDIDATES = 1000


def frequent_tokens(df: DataFrame, column: str = "genres", alias: str = "genre", n: int = 15,
                    drop_empty: bool = False, candidates: int = CANDIDATES) -> DataFrame:
    """The `n` most frequent tokens with their counts, as `rollup.token_counts` gives them.

    The candidates, at most `candidates` tokens, are looked at by the driver.
    """
    tokens = explode_tokens(df.select(column), column, alias, drop_empty)
    told = tokens.agg(F.count("*").alias("total"), F.expr(
        f"approx_top_k(`{alias}`, {int(candidates)}, {TRACKED})").alias("top")).first()
    found = [(r["item"], r["count"]) for r in told["top"] or []]
    if not found:
        return token_counts(df, column, alias, n, drop_empty)
    wanted = tokens.filter(F.col(alias).isin([token for token, _ in found]))
    counts = wanted.groupBy(alias).agg(F.count("*").alias("count"))
    best = counts.orderBy(F.desc("count"), F.asc(alias)).limit(n)
    rows = best.collect()
    # An estimate is never too low.  A token that is not listed was not tracked, or has no higher
    # estimate than the last one listed.
    most = told["total"] * ERROR_SHARE
    if len(found) >= candidates:
        most = max(most, found[-1][1])
    if len(rows) < min(n, len(found)) or (len(rows) == n and rows[-1]["count"] <= most) or (
            len(rows) < n and told["total"] != sum(r["count"] for r in rows)):
        return token_counts(df, column, alias, n, drop_empty)
    return df.sparkSession.createDataFrame(rows, best.schema)

"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted per cell (one value of each margin column, for instance
source x language x topic). The cells are raked: scaled margin by margin until
every margin has its target shares. A document's probability is the factor of
its cell, divided by the largest factor, so the sample has the target shares in
expectation and no document is repeated.

Values without a target are one value, ``other``, so the number of cells is
bounded by the targets that the caller writes down, whatever the corpus holds.
Only that table reaches the driver, and only the factors made from it go out
again. The draw is a hash of the id: a rerun keeps the same documents.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.llm.common import whole_text

OTHER = "other"
ROUNDS = 30
Targets = Mapping[str, Mapping[str, float]]


def token_count(text: Column) -> Column:
    """Words as counted by the blanks and line ends between them; 0 for an empty text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.length(text) == 0, 0).otherwise(
        F.length(text) - F.length(F.translate(text, " \n", "")) + 1
    ).cast("bigint")


def topic_of(text: Column) -> Column:
    """A coarse topic from the form of the text: listing, loud, marked, short or prose."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return (
        F.when(F.contains(text, F.lit(" | ")), "listing")
        .when(F.contains(text, F.lit("!! ")), "loud")
        .when(F.contains(text, F.lit("%%% ")), "marked")
        .when(F.length(text) < 600, "short")
        .otherwise("prose")
    )


def draw(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) from the id: 48 bits of an MD5 sum."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def category(column: Column, shares: Mapping[str, float]) -> Column:
    """The value if it has a target, else ``other``; null is ``other`` too."""
    column = column.cast("string")
    return F.when(column.isin(*[v for v in shares if v != OTHER]), column).otherwise(OTHER)


def margin_targets(shares: Mapping[str, float], present: Sequence[str]) -> dict[str, float]:
    """Target share of each value that occurs: what is left of 1 goes to ``other``."""
    wanted = {k: float(v) for k, v in shares.items() if k != OTHER}
    wanted[OTHER] = float(shares.get(OTHER, max(0.0, 1.0 - sum(wanted.values()))))
    wanted = {k: v for k, v in wanted.items() if k in present}
    total = sum(wanted.values())
    return {k: v / total for k, v in wanted.items()} if total > 0 else dict.fromkeys(wanted, 1.0 / max(1, len(wanted)))


def rake(cells: Mapping[tuple[str, ...], float], targets: Sequence[Mapping[str, float]], rounds: int = ROUNDS) -> dict:
    """Factor per cell after ``rounds`` rounds over all margins."""
    total = float(sum(cells.values()))
    weight = {k: float(v) for k, v in sorted(cells.items()) if v > 0}
    shares = [margin_targets(t, sorted({k[i] for k in weight})) for i, t in enumerate(targets)]
    for _ in range(rounds):
        for i, share in enumerate(shares):
            sums = dict.fromkeys(share, 0.0)
            for k, w in weight.items():
                sums[k[i]] += w
            weight = {k: w * (share[k[i]] * total / sums[k[i]] if sums[k[i]] else 0.0) for k, w in weight.items()}
    return {k: w / cells[k] for k, w in weight.items()}


def mix(
    docs: DataFrame,
    targets: Targets,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
    seed: int = 0,
    floor: float = 0.0,
) -> DataFrame:
    """The sampled documents, with ``tokens`` and ``keep_probability`` added.

    ``targets`` maps margin columns of ``docs`` to shares of tokens. Documents
    without tokens carry no weight: they take the factor of their cell, or stay
    if the cell has no tokens at all. Repeated rows of one id share one draw.
    ``floor`` is the least probability of any document. An empty table gives an
    empty table.
    """
    docs = docs.withColumn("tokens", token_count(F.col(text_col)))
    margins = list(targets)
    names = [f"__margin{i}" for i in range(len(margins))]
    for name, margin in zip(names, margins, strict=True):
        docs = docs.withColumn(name, category(F.col(margin), targets[margin]))
    rows = docs.groupBy(*names).agg(F.sum("tokens").alias("tokens")).collect()
    factors = rake({tuple(r[n] for n in names): r["tokens"] for r in rows}, [targets[m] for m in margins], rounds)
    top = max(factors.values(), default=1.0) or 1.0
    spark = docs.sparkSession
    rates = spark.createDataFrame(
        [(*k, max(floor, f / top)) for k, f in factors.items()] or [(*names, 1.0)],
        ", ".join(f"{n} string" for n in names) + ", __rate double",
    )
    # As many rows as there are cells: bounded by the targets.
    return (
        docs.join(F.broadcast(rates), names, "left")
        .withColumn("keep_probability", F.coalesce("__rate", F.lit(1.0)))
        .where(draw(F.col(id_col), seed) < F.col("keep_probability"))
        .drop(*names, "__rate")
    )


def mixing_sql(table: str, targets: Mapping[str, tuple[str, Mapping[str, float]]], rounds: int, seed: int) -> str:
    """The same sample as one SQL statement: the rounds are unrolled over window sums.

    ``targets`` gives for each margin its SQL expression and its shares.
    """
    n = len(targets)
    words = "CASE WHEN length(coalesce(text,''))=0 THEN 0 ELSE length(text)-length(translate(text, ' '||chr(10), ''))+1 END"
    cats, shares = [], []
    for i, (expr, share) in enumerate(targets.values()):
        listed = ", ".join(f"'{v}'" for v in share if v != OTHER)
        cats.append(f"CASE WHEN {expr} IN ({listed}) THEN {expr} ELSE '{OTHER}' END AS m{i}")
        left = share.get(OTHER, max(0.0, 1.0 - sum(v for k, v in share.items() if k != OTHER)))
        values = ", ".join(f"('{k}', {v!r}::DOUBLE)" for k, v in {**share, OTHER: left}.items())
        shares.append(
            f"s{i} AS (SELECT v, w / sum(w) OVER () AS share FROM (VALUES {values}) t(v, w)"
            f" WHERE v IN (SELECT m{i} FROM c))"
        )
    margins = ", ".join(f"m{i}" for i in range(n))
    steps, last = [], "c"
    for r in range(rounds):
        for i in range(n):
            name = f"r{r}_{i}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT {margins}, tokens, w * share * (sum(tokens) OVER ())"
                f" / (sum(w) OVER (PARTITION BY m{i})) AS w FROM {last} JOIN s{i} ON m{i} = v)"
            )
            last = name
    return (
        f"WITH d AS (SELECT *, {words} AS tokens FROM {table}), e AS (SELECT *, {', '.join(cats)} FROM d),"
        f" c AS MATERIALIZED (SELECT {margins}, sum(tokens)::BIGINT AS tokens, sum(tokens)::DOUBLE AS w FROM e"
        f" GROUP BY ALL HAVING sum(tokens) > 0), {', '.join(shares)}, {', '.join(steps)},"
        f" f AS (SELECT {margins}, w / tokens / max(w / tokens) OVER () AS rate FROM {last})"
        f" SELECT e.*, coalesce(rate, 1.0) AS keep_probability FROM e LEFT JOIN f USING ({margins})"
        f" WHERE ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE / {2**48}.0"
        f" < coalesce(rate, 1.0)"
    )


__all__ = ["mix", "mixing_sql", "rake", "token_count", "topic_of", "whole_text"]

"""Mixing sources to target weights by iterative proportional fitting, with
DataFrame functions only.

Tokens are counted per (source, language, topic) cell; the cells' weights are
raked to the target shares of each dimension in turn, and every document is
kept with its cell's calibrated probability (``kept``, at most once) or
repeated so that the raked shares are met (``copies``).  Only cells (one row per distinct
combination) go through the sweeps; the documents are read once to count and
once to sample, and are never shuffled while the cells are proven few.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import common
from tallyspark.operators.sizing import lookup_join, proven_small

#: Cells and marginals up to this many rows are broadcast.
FEW = 50_000
DIMS = ("source", "lang", "topic")
SWEEPS = 10
SCALE_STEPS = 8
#: Target share of a value = its natural share to this power, normalised.
TEMPER = 0.7
#: Expected share of all tokens that is kept.
KEEP_SHARE = 0.8
#: Decimals kept of a probability.
DIGITS = 9


def tokens_of(text: Column) -> Column:
    """Token weight: a quarter of the UTF-8 bytes, at least one."""
    return F.greatest(F.lit(1), F.ceil(F.octet_length(common.text_or_empty(text)) / 4)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic from the whole text: tabular, reference or prose."""
    return (F.when(text.contains("|"), "tabular").when(text.rlike("[0-9]"), "reference")
            .otherwise("prose"))


def tempered(cells: DataFrame, dim: str, power: float = TEMPER) -> DataFrame:
    """(dim, share): the default target marginal of ``dim``."""
    own = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t"))
    own = own.withColumn("t", F.pow("t", F.lit(power)))
    whole = own.agg(F.sum("t")).first()[0] or 1.0
    return own.select(dim, (F.col("t") / whole).alias("share"))


def _scaled(cells: DataFrame, factors: dict[str, DataFrame], few: dict[str, bool]) -> DataFrame:
    """``cells`` plus ``weight``: their tokens times the factor of each listed
    dimension (cells without one are left out)."""
    weight = F.col("tokens").cast("double")
    for dim, factor in factors.items():
        side = factor.select(F.col(dim).alias(f"__{dim}"), F.col("factor").alias(f"__f_{dim}"))
        cells = lookup_join(cells, side, F.col(dim).eqNullSafe(F.col(f"__{dim}")), known_small=few[dim])
        weight = weight * F.col(f"__f_{dim}")
    return cells.withColumn("weight", weight)


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (dims, tokens) plus ``weight``: tokens scaled so that the
    weights' marginals meet ``targets`` ((dim, share) frames).

    Only the factors of each dimension's values change from step to step (one
    row per value, written); the cells stay as they are, so every step has the
    same small plan and nothing of an earlier step in it."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    few = {d: proven_small(t, FEW) for d, t in targets.items()}
    factors = {d: t.select(d, F.lit(1.0).alias("factor")) for d, t in targets.items()}
    for _ in range(sweeps):
        for dim, target in targets.items():
            now = (_scaled(cells, {d: f for d, f in factors.items() if d != dim}, few)
                   .groupBy(F.col(dim).alias("__d")).agg(F.sum("weight").alias("now")))
            met = lookup_join(now, target, F.col("__d").eqNullSafe(F.col(dim)), known_small=few[dim])
            factors[dim] = common.stored(met.select(dim, F.coalesce(
                F.try_divide(F.col("share") * total, "now"), F.lit(0.0)).alias("factor")),
                                         f"raked-{dim}")
    return common.stored(_scaled(cells, factors, few).select(*cells.columns, "weight"), "raked-cells")


def sampling_rates(raked: DataFrame, keep_share: float = KEEP_SHARE, steps: int = SCALE_STEPS) -> DataFrame:
    """``raked`` plus ``rate``: min(1, scale * weight / tokens), with one scale
    for all cells at which ``keep_share`` of the tokens are expected, and
    ``times``: the expected copies of a document, not clipped, at which the
    same share is expected and the raked marginals are met."""
    total, weights = raked.agg(F.sum("tokens"), F.sum("weight")).first()
    scale, total = float(keep_share), total or 0
    whole = scale * total / weights if weights else 0.0
    ratio = F.col("weight") / F.col("tokens")
    for _ in range(steps):
        kept = raked.agg(F.sum(F.least(F.lit(1.0), F.lit(scale) * ratio) * F.col("tokens"))).first()[0]
        if kept:
            scale = scale * (keep_share * total) / kept
    return raked.withColumn("rate", F.round(F.least(F.lit(1.0), F.lit(scale) * ratio), DIGITS)).withColumn(
        "times", F.round(F.lit(whole) * ratio, DIGITS))


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A uniform number in [0, 1) that depends on seed, doc_id and text alone."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"),
                   common.text_or_empty(text))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def drawn(docs: DataFrame, *keep: Column, seed: int = 1, keep_share: float = KEEP_SHARE,
          targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """``keep`` columns plus a struct column ``__mix`` (source, lang, topic,
    tokens, rate, kept, copies).  Whole rows are kept as one struct
    (``common.whole_row``), so no name can clash.

    ``kept`` takes a document once at most, so cells that would need more than
    all their documents fall short of the targets.  ``copies`` meets them: the
    whole part of the cell's expected copies, and one more by the draw.

    A null source or language is a value of its own; null and empty texts are
    prose of one token; fully equal rows share one draw.  ``targets`` maps
    dimensions to (dimension, share) frames; others take tempered shares, and
    a value that a given frame does not list has rate 0."""
    common.ready(docs.sparkSession)
    text = F.col("text").cast("string")
    dims = [F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
            topic_of(common.text_or_empty(text)).alias("topic")]
    cells = common.stored(docs.select(*dims, tokens_of(text).alias("tokens"))
                          .groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    targets = {d: (targets or {}).get(d) or common.stored(tempered(cells, d), f"mix-{d}") for d in DIMS}
    rates = common.stored(sampling_rates(rake(cells, targets), keep_share), "mix-rates").select(
        *[F.col(d).alias(f"__{d}") for d in DIMS], F.col("rate").alias("__rate"), F.col("times").alias("__times"))
    rows = docs.select(*keep, F.struct(*dims, tokens_of(text).alias("tokens")).alias("__own"),
                       draw(F.col("doc_id"), text, seed).alias("__draw"))
    kept = rows.drop("__own", "__draw").columns
    on = reduce(lambda a, b: a & b, [F.col(f"__own.{d}").eqNullSafe(F.col(f"__{d}")) for d in DIMS])
    joined = lookup_join(rows, rates, on, "left", FEW)
    rate, times = F.coalesce("__rate", F.lit(0.0)), F.coalesce("__times", F.lit(0.0))
    copies = F.floor(times) + (F.col("__draw") < times - F.floor(times)).cast("long")
    return joined.select(*[F.col(f"`{c}`") for c in kept], F.struct(
        "__own.source", "__own.lang", "__own.topic", "__own.tokens", rate.alias("rate"),
        (F.col("__draw") < rate).alias("kept"), copies.cast("int").alias("copies")).alias("__mix"))


def mix(docs: DataFrame, seed: int = 1, keep_share: float = KEEP_SHARE,
        targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """``docs`` plus the struct column ``__mix`` of ``drawn``."""
    return drawn(docs, common.whole_row(docs), seed=seed, keep_share=keep_share, targets=targets).select(
        "doc.*", "__mix")


def mix_report(docs: DataFrame, seed: int = 1) -> DataFrame:
    return drawn(docs, F.col("doc_id"), seed=seed).select("doc_id", *[F.col(f"__mix.{c}").alias(c) for c in
                                              ("source", "lang", "topic", "tokens", "rate", "kept", "copies")])


def oracle_sql(seed: int = 1) -> str:
    """The same in DuckDB SQL: the sweeps unrolled, every step a table."""
    dims = ", ".join(DIMS)
    out = [f"""d AS (SELECT doc_id, source, lang, text, CASE WHEN contains(coalesce(text, ''), '|') THEN 'tabular'
      WHEN regexp_matches(coalesce(text, ''), '[0-9]') THEN 'reference' ELSE 'prose' END AS topic,
      greatest(1, ceil(octet_length(encode(coalesce(text, ''))) / 4))::BIGINT AS tokens FROM documents)""",
           f"""c0 AS MATERIALIZED (SELECT {dims}, sum(tokens)::BIGINT AS tokens, sum(tokens)::DOUBLE AS weight
      FROM d GROUP BY ALL)"""]
    for dim in DIMS:
        out.append(f"""t_{dim} AS MATERIALIZED (SELECT {dim} AS v, pow(sum(tokens)::DOUBLE, {TEMPER}) /
      sum(pow(sum(tokens)::DOUBLE, {TEMPER})) OVER () AS share FROM c0 GROUP BY {dim})""")
    last, step = "c0", 0
    for _ in range(SWEEPS):
        for dim in DIMS:
            step += 1
            out.append(f"""c{step} AS MATERIALIZED (SELECT {dims}, tokens, weight * (t.share *
      (SELECT sum(tokens) FROM c0)::DOUBLE / sum(weight) OVER (PARTITION BY {dim})) AS weight
      FROM {last} c JOIN t_{dim} t ON c.{dim} IS NOT DISTINCT FROM t.v)""")
            last = f"c{step}"
    out.append(f"s0 AS (SELECT {KEEP_SHARE}::DOUBLE AS s)")
    for i in range(SCALE_STEPS):
        out.append(f"""s{i + 1} AS MATERIALIZED (SELECT any_value(s) * ({KEEP_SHARE} * sum(tokens)) /
      sum(least(1.0::DOUBLE, s * weight / tokens) * tokens) AS s FROM {last}, s{i})""")
    out.append(f"""r AS (SELECT {dims}, round(least(1.0::DOUBLE, s * weight / tokens), {DIGITS}) AS rate,
      round({KEEP_SHARE} * (SELECT sum(tokens) FROM c0) / (SELECT sum(weight) FROM {last}) * weight / tokens,
        {DIGITS}) AS times FROM {last}, s{SCALE_STEPS})""")
    out.append(f"""u AS (SELECT *, ('0x' || substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, '') || '|' ||
      coalesce(text, '')), 1, 12))::BIGINT::DOUBLE / {float(1 << 48)!r}::DOUBLE AS draw FROM d)""")
    return "WITH " + ",\n".join(out) + """
    SELECT doc_id, d.source, d.lang, d.topic, tokens, rate, draw < rate AS kept,
      (floor(times) + (draw < times - floor(times))::INT)::INT AS copies
    FROM u d JOIN r ON d.source IS NOT DISTINCT FROM r.source AND d.lang IS NOT DISTINCT FROM r.lang
      AND d.topic = r.topic"""

"""Mixing sources to target weights: raking of token weights to several marginals, then sampling of documents.

Only DataFrame functions. Raking works on cells, one for each combination of the dimensions that occurs; documents meet
their cell's probability in one join at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .staging import staged

DIMENSIONS = ("source", "lang", "topic")
#: Shares that languages and topics should get; a value not named here keeps its own share, and all are scaled to 1.
TARGETS = {
    "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1},
    "topic": {"prose": 0.5, "long": 0.25, "short": 0.1, "table": 0.1, "licensed": 0.05},
}
#: Sources get shares in proportion to this power of their own: large ones are held down, none is lost.
TEMPER = {"source": 0.5}
SWEEPS = 16
#: Shares of the sample are this near to their goals, by their own size or by a tenth of it of the whole sample.
TOLERANCE = 0.01
#: Where a sweep leaves more than this part of the last one's distance, less is kept.
STALLED, SMALLER = 0.7, 0.95
#: A probability from here on counts as 1, whatever the order its sums were taken in.
FULL = 0.999999999
#: Share of all tokens that the sample should have; less where the goals cannot be met at that size.
KEEP = 0.7
CLIPPING_ROUNDS = 8
SEED = "mix-1"
#: Word counts at which a text is short, and long.
SHORT, LONG = 60, 1000
NONE = "(none)"


def tokens_of(text: Column) -> Column:
    """Words between white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def topic_of(text: Column, tokens: Column) -> Column:
    """A topic from the form of a text: table, licensed, short, long or prose."""
    return (F.when(F.contains(text, F.lit(" | ")), "table").when(F.contains(text, F.lit("icense")), "licensed")
            .when(tokens < SHORT, "short").when(tokens >= LONG, "long").otherwise("prose"))


def goals(cells: DataFrame, keep: float, targets: dict[str, dict[str, float]] = TARGETS, temper: dict[str, float] = TEMPER) -> DataFrame:
    """(dim, value, goal): the shares that the sample's values should have, for every value that has tokens.

    Targets are scaled to 1 in each dimension. A value can fill ``keep`` of all tokens with no more than its own, so its
    goal is at most own / keep; what that takes away goes to the other values in proportion to their targets.
    """
    dimensions = [*targets, *[d for d in temper if d not in targets]]
    stacked = reduce(DataFrame.union, [cells.select(F.lit(d).alias("dim"), F.col(d).alias("value"), "share") for d in dimensions])
    own = stacked.groupBy("dim", "value").agg(F.sum("share").alias("own")).where("own > 0")
    wanted = reduce(lambda c, d: c.when(F.col("dim") == d, F.pow("own", F.lit(temper[d]))), [d for d in temper if d not in targets], F.when(F.lit(False), 0.0))
    wanted = reduce(lambda c, dvs: c.when((F.col("dim") == dvs[0]) & (F.col("value") == dvs[1]), F.lit(dvs[2])),
                    [(d, v, share) for d in targets for v, share in targets[d].items()], wanted)
    own = staged(own.withColumn("wanted", F.coalesce(wanted, "own")), "marginals")
    cap = F.col("own") / F.lit(keep)
    scale = {r["dim"]: 1.0 / r["sum"] for r in own.groupBy("dim").agg(F.sum("wanted").alias("sum")).collect()}  # one row a dimension
    for _ in range(CLIPPING_ROUNDS):
        level = F.col("wanted") * reduce(lambda c, kv: c.when(F.col("dim") == kv[0], F.lit(kv[1])), scale.items(), F.when(F.lit(False), 0.0))
        full = level >= cap
        sums = own.groupBy("dim").agg(F.sum(F.when(full, cap).otherwise(0.0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("wanted"))).alias("free"))
        new = {r["dim"]: max(1.0 - r["full"], 0.0) / r["free"] if r["free"] else scale[r["dim"]] for r in sums.collect()}
        if new == scale:
            break
        scale = new
    level = F.col("wanted") * reduce(lambda c, kv: c.when(F.col("dim") == kv[0], F.lit(kv[1])), scale.items(), F.when(F.lit(False), 0.0))
    return staged(own.select("dim", "value", F.least(level, cap).alias("goal")), "goals")


def rake(cells: DataFrame, keep: float = KEEP, targets: dict[str, dict[str, float]] = TARGETS, temper: dict[str, float] = TEMPER) -> tuple[DataFrame, float]:
    """Cells (dimensions, tokens) with ``share``, their part of all tokens, and the ``probability`` of their documents; and
    the part of all tokens that is kept.

    Iterative proportional fitting under a cap: in turn for each dimension, the probabilities below 1 are scaled so
    that the expected tokens of each value become ``keep`` times its goal. Where the goals of several dimensions cannot be
    met together at that size, a sweep does not come much nearer than the last one, and ``keep`` is lowered by a
    twentieth. It ends when every value is within TOLERANCE of its goal, or after SWEEPS. Each step is one aggregate and
    one join of the written cells, by whole numbers that stand for the values: such a join keeps a table of its own size in
    the memory of every executor, one by text keeps a page of many megabytes until the driver lets go of it.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    cells = staged(cells.withColumn("share", F.col("tokens") / F.lit(float(total))).withColumn("r", F.lit(keep)).withColumn("off", F.lit(0.0)), "shares")
    wanted = staged(goals(cells, keep, targets, temper).withColumn("id", F.monotonically_increasing_id()), "wanted")
    dimensions = [*targets, *[d for d in temper if d not in targets]]
    columns = cells.columns
    for d in dimensions:  # a value without tokens has no goal and gets no number
        cells = cells.join(wanted.where(F.col("dim") == d).select(F.col("value").alias(d), F.col("id").alias(f"{d}_id"), F.col("goal").alias(f"{d}_goal")), d, "left")
    cells = staged(cells.select(*columns, *[f"{d}_{x}" for d in dimensions for x in ("id", "goal")]), "numbered")
    before, scale = None, 1.0
    for _ in range(SWEEPS):
        for d in dimensions:
            r = F.col("r") * F.lit(scale)
            own = cells.groupBy(f"{d}_id").agg(
                F.sum(F.when(r >= FULL, F.col("share")).otherwise(0.0)).alias("full"),
                F.sum(F.when(r >= FULL, 0.0).otherwise(F.col("share") * r)).alias("free"), F.max(f"{d}_goal").alias("goal"))
            want, sum_ = F.col("goal") * F.lit(keep), F.col("full") + F.col("free")
            factor = F.when(sum_ > want, want / sum_).when(F.col("free") > 0, (want - F.col("full")) / F.col("free")).otherwise(1.0)
            off = F.abs(sum_ - want) / F.greatest(F.lit(TOLERANCE) * want, F.lit(TOLERANCE / 10 * keep))
            step = own.select(f"{d}_id", factor.alias("factor"), off.alias("step_off"))
            r = F.when(F.col("factor").isNull(), 0.0).when((r >= FULL) & (F.col("factor") > 1), 1.0).otherwise(F.least(F.lit(1.0), r * F.col("factor")))
            cells = staged(cells.join(step, f"{d}_id", "left").select(
                *[x for x in cells.columns if x not in ("r", "off")], r.alias("r"),
                F.greatest("off" if d != dimensions[0] else F.lit(0.0), F.coalesce("step_off", F.lit(0.0))).alias("off")), "cells")
            scale = 1.0
        off = cells.agg(F.max("off")).first()[0] or 0.0
        if off <= 1:
            break
        if before is not None and off > STALLED * before:
            keep, scale = keep * SMALLER, SMALLER
        before = off
    return cells.select(*[x for x in columns if x not in ("r", "off")], F.round(F.col("r") * F.lit(scale), 9).alias("probability")), keep


def mix(docs: DataFrame, topic: Column | None = None, keep: float = KEEP, seed: str = SEED) -> DataFrame:
    """All columns of ``docs`` in a struct ``document``, and a struct ``mix``: source, lang, topic, tokens, probability, sampled
    and kept_share, the part of all tokens that the probabilities are made for.

    Null or missing dimension values form the value "(none)". A document is sampled if a hash of seed and doc_id, as a
    number below 1, is below its cell's probability: repeated rows share one decision, and a null id is replaced by
    the hash of the text. Documents without words are not sampled. Nothing is drawn at random, so a rerun gives the same rows.
    """
    rows = docs.select(F.struct("*").alias("document")).withColumn("tokens", tokens_of(F.col("document.text")))
    found = topic if topic is not None else topic_of(F.col("document.text"), F.col("tokens"))
    rows = rows.select("document", "tokens", *[F.coalesce(F.col(f"document.{d}"), F.lit(NONE)).alias(d) for d in ("source", "lang")],
                       F.when(F.col("document.text").isNull(), NONE).otherwise(found).alias("topic"))
    narrow = rows.select(*DIMENSIONS, "tokens")
    cells, kept = rake(staged(narrow.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "tokens"), keep)
    name = F.coalesce(F.col("document.doc_id").cast("string"), F.md5("document.text"), F.lit(""))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))
    joined = rows.join(cells.select(*DIMENSIONS, "probability"), list(DIMENSIONS))
    return joined.select("document", F.struct(*DIMENSIONS, "tokens", "probability", ((F.col("tokens") > 0) & (draw < F.col("probability"))).alias("sampled"),
                                               F.lit(round(kept, 9)).alias("kept_share")).alias("mix"))


def oracle_sql() -> str:
    """The same computation in SQL, with each round as a query of its own."""
    parts = [f"""d AS MATERIALIZED (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, text,
  CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS tokens FROM documents)""",
             f"""e AS MATERIALIZED (SELECT *, CASE WHEN text IS NULL THEN '{NONE}' WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, 'icense') THEN 'licensed'
  WHEN tokens < {SHORT} THEN 'short' WHEN tokens >= {LONG} THEN 'long' ELSE 'prose' END AS topic FROM d)""",
             "c AS MATERIALIZED (SELECT source, lang, topic, sum(tokens) AS tokens FROM e GROUP BY ALL)",
             "c0 AS MATERIALIZED (SELECT *, tokens / (SELECT sum(tokens)::DOUBLE FROM c) AS share FROM c)"]
    dimensions = [*TARGETS, *TEMPER]
    named = " ".join(f"WHEN dim = '{d}' AND value = '{v}' THEN {s}::DOUBLE" for d in TARGETS for v, s in TARGETS[d].items())
    tempered = " ".join(f"WHEN dim = '{d}' THEN pow(own, {p})" for d, p in TEMPER.items())
    stacked = " UNION ALL ".join(f"SELECT '{d}' AS dim, {d} AS value, share FROM c0" for d in dimensions)
    parts.append(f"m AS MATERIALIZED (SELECT *, CASE {named} {tempered} ELSE own END AS wanted FROM (SELECT dim, value, sum(share) AS own FROM ({stacked}) GROUP BY ALL) WHERE own > 0)")
    parts.append("l0 AS MATERIALIZED (SELECT dim, 1 / sum(wanted) AS scale FROM m GROUP BY dim)")
    for i in range(CLIPPING_ROUNDS):  # further rounds change nothing once one did not
        full, free = (f"sum(CASE WHEN wanted * scale >= own / {KEEP}::DOUBLE THEN {x} END)" for x in (f"own / {KEEP}::DOUBLE ELSE 0", "0 ELSE wanted"))
        parts.append(f"l{i + 1} AS MATERIALIZED (SELECT dim, CASE WHEN {free} > 0 THEN greatest(1 - {full}, 0) / {free} ELSE max(scale) END AS scale FROM m JOIN l{i} USING (dim) GROUP BY dim)")
    parts.append(f"g AS MATERIALIZED (SELECT dim, value, least(wanted * scale, own / {KEEP}::DOUBLE) AS goal FROM m JOIN l{CLIPPING_ROUNDS} USING (dim))")
    parts.append(f"w0 AS MATERIALIZED (SELECT *, {KEEP}::DOUBLE AS r, 0::DOUBLE AS off FROM c0)")
    parts.append(f"k0 AS MATERIALIZED (SELECT {KEEP}::DOUBLE AS keep, 1::DOUBLE AS scale, NULL::DOUBLE AS before, FALSE AS done)")
    n = 0
    for k in range(SWEEPS):
        for d in dimensions:
            r = "r" if d != dimensions[0] else "r * scale"
            off = "off" if d != dimensions[0] else "0"
            parts.append(f"""w{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (keep, scale, before, done, goal, want, filled, free, total, factor) REPLACE (CASE WHEN done THEN r WHEN goal IS NULL THEN 0 WHEN {r} >= {FULL} AND factor > 1 THEN 1 ELSE least(1, {r} * factor) END AS r,
  CASE WHEN done THEN 0 ELSE greatest({off}, coalesce(abs(total - want) / greatest({TOLERANCE} * want, {TOLERANCE / 10} * keep), 0)) END AS off) FROM (
  SELECT *, CASE WHEN total > want THEN want / total WHEN free > 0 THEN (want - filled) / free ELSE 1 END AS factor FROM (SELECT *, filled + free AS total FROM (
  SELECT w{n}.*, k{k}.*, goal, goal * keep AS want, sum(CASE WHEN {r} >= {FULL} THEN share ELSE 0 END) OVER (PARTITION BY {d}) AS filled,
  sum(CASE WHEN {r} >= {FULL} THEN 0 ELSE share * {r} END) OVER (PARTITION BY {d}) AS free FROM w{n} CROSS JOIN k{k} LEFT JOIN g ON dim = '{d}' AND value = {d}))))""")
            n += 1
        lower = f"NOT done AND off > 1 AND before IS NOT NULL AND off > {STALLED} * before"
        parts.append(f"""k{k + 1} AS MATERIALIZED (SELECT CASE WHEN {lower} THEN keep * {SMALLER} ELSE keep END AS keep, CASE WHEN {lower} THEN {SMALLER} ELSE 1 END AS scale,
  off AS before, done OR off <= 1 AS done FROM k{k}, (SELECT max(off) AS off FROM w{n}))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT e.doc_id, e.source, e.lang, e.topic, e.tokens, p.probability,
       e.tokens > 0 AND ('0x' || substr(md5('{SEED}:' || coalesce(e.doc_id::VARCHAR, md5(e.text), '')), 1, 13))::BIGINT::DOUBLE / {float(16 ** 13)!r} < p.probability AS sampled, p.kept_share
FROM e JOIN (SELECT source, lang, topic, round(r * scale, 9) AS probability, round(keep, 9) AS kept_share FROM w{n}, k{SWEEPS}) p
  ON e.source = p.source AND e.lang = p.lang AND e.topic = p.topic"""

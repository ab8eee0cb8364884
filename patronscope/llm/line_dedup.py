"""Boilerplate lines: lines on many distinct sites, by HyperLogLog sketches and exact counts near the threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .staging import staged

#: A line on so many distinct sites is boilerplate.
MIN_SITES = 10
#: Sketch size as a power of two: a relative standard error of 1.6 %.
SKETCH_BITS = 12
#: Estimates within this share of the threshold (over six standard errors) are counted exactly.
NEAR = 0.1
_BLANKS = " \t\r"


def _key(line: Column) -> Column:
    """128-bit hash of a line without the blanks around it; null for a blank line, which is never boilerplate."""
    trimmed = F.btrim(line, F.lit(_BLANKS))
    return F.when(trimmed != "", F.unhex(F.md5(trimmed)))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Keys of lines (key, site) on at least ``min_sites`` sites; where ``lines`` has a digest, keys of two or more digests.

    One sketch for each key, merged from the partial sketches of the map side, decides clear cases. Keys whose
    estimate is near the threshold are counted exactly; each has about ``min_sites`` sites, so that stays small.
    """
    several = F.min("digest") < F.max("digest") if "digest" in lines.columns else F.lit(True)
    spread = staged(lines.groupBy("key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"), several.alias("several"))
                    .where(F.col("several") & (F.col("sites") >= min(min_sites * (1 - NEAR), min_sites - 1))).drop("several"), "spread")
    top = max(min_sites * (1 + NEAR), min_sites + 1)
    near = spread.where(F.col("sites") <= top).select("key")
    exact = (lines.join(near, "key").select("key", "site").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") >= min_sites).select("key"))
    return staged(spread.where(F.col("sites") > top).select("key").union(exact), "boilerplate")


def line_dedup(docs: DataFrame, min_sites: int = MIN_SITES, site: str = "source") -> DataFrame:
    """All columns of ``docs`` in a struct ``document`` with the cleaned text, and a struct ``lines`` with n_lines,
    n_removed and emptied.

    A boilerplate line goes from every text but the one with the smallest doc_id (then smallest md5) that has it, so a
    copy of its content stays in the corpus. A line is on every site of every copy of its texts; lines of a single text
    are spared, so copying a document does not turn its lines into boilerplate, and all copies are cleaned alike. A
    null site is a site of its own; a null id counts as larger than all others; a null text stays null and has no lines. ``emptied``: no word
    is left of a text that had some. Lines are what a split at line feeds gives, compared without blanks around them;
    blank lines stay. Where ``docs`` has n_chars it is brought up to date.
    """
    digest = F.unhex(F.md5("document.text"))
    narrow = docs.select(F.struct("*").alias("document")).where(F.col("document.text").isNotNull()).select(
        digest.alias("digest"), F.coalesce(F.col(f"document.{site}").cast("string"), F.lit("")).alias("site"),
        F.struct(F.col("document.doc_id").isNull().alias("no_id"), F.col("document.doc_id").alias("doc_id")).alias("id"),
        F.transform(F.split("document.text", "\n", -1), _key).alias("keys"))
    texts = staged(narrow.groupBy("digest", "site").agg(F.min("id").alias("id"), F.any_value("keys").alias("keys")), "texts")
    lines = texts.select("digest", "site", "id", F.posexplode("keys").alias("at", "key")).where(F.col("key").isNotNull())
    found = boilerplate(lines.select("key", "site", "digest"), min_sites)

    hits = staged(lines.join(found, "key").select("key", "at", "digest", "id"), "hits")
    holders = hits.groupBy("key").agg(F.min(F.struct("id", "digest"))["digest"].alias("holder"))
    # Written first, so that adaptive execution may split the join where one text has very many copies.
    removed = staged(hits.join(holders, "key").where("digest <> holder").groupBy("digest").agg(F.collect_set("at").alias("gone")), "removed")

    rows = docs.select(F.struct("*").alias("document")).withColumn("digest", digest).join(removed, "digest", "left")
    rows = rows.withColumn("parts", F.split("document.text", "\n", -1))
    count = F.when(F.col("parts").isNull(), 0).otherwise(F.size("parts"))
    # array_except is linear and keeps the order, so very long texts stay cheap.
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("document.text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("parts", i)), "\n"))
    rows = rows.select("document", text.alias("cleaned"), count.cast("bigint").alias("n_lines"),
                       F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0)).cast("bigint").alias("n_removed"))
    word = "[^\\x20\\x09-\\x0D]"
    document = F.col("document").withField("text", F.col("cleaned"))
    if "n_chars" in docs.columns:
        document = document.withField("n_chars", F.when(F.col("n_removed") > 0, F.char_length("cleaned").cast(docs.schema["n_chars"].dataType))
                                      .otherwise(F.col("document.n_chars")))
    return rows.select(document.alias("document"), F.struct(
        "n_lines", "n_removed", ((F.col("n_removed") > 0) & ~F.col("cleaned").rlike(word)).alias("emptied")).alias("lines"))


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, text, coalesce(source, '') AS site FROM documents),
t AS MATERIALIZED (SELECT text, min(doc_id) AS doc_id FROM d WHERE text IS NOT NULL GROUP BY text),
s AS MATERIALIZED (SELECT DISTINCT t.doc_id, d.site FROM d JOIN t USING (text)),
l AS MATERIALIZED (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS line FROM t),
b AS MATERIALIZED (SELECT line, min(doc_id) AS holder FROM l JOIN s USING (doc_id) WHERE line <> '' GROUP BY line
                   HAVING count(DISTINCT site) >= {MIN_SITES} AND count(DISTINCT doc_id) > 1),
r AS MATERIALIZED (SELECT l.doc_id, list(DISTINCT l.line) AS gone FROM l JOIN b USING (line) WHERE l.doc_id <> b.holder GROUP BY l.doc_id),
c AS (SELECT t.text, string_split(t.text, chr(10)) AS parts,
             list_filter(string_split(t.text, chr(10)), lambda x: NOT list_contains(coalesce(r.gone, []), trim(x, ' ' || chr(9) || chr(13)))) AS stay
      FROM t LEFT JOIN r USING (doc_id))
SELECT d.doc_id, coalesce(len(c.parts), 0) AS n_lines, coalesce(len(c.parts) - len(c.stay), 0) AS n_removed,
       md5(array_to_string(c.stay, chr(10))) AS text_md5
FROM d LEFT JOIN c ON d.text = c.text
"""

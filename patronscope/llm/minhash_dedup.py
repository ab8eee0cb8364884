"""Near-duplicates by MinHash bands, odd sketches and an exact check on whole shingle sets.

A node is a distinct set of shingles, named by a 128-bit digest; documents with equal sets share it, so exact copies
cost one row. MinHash samples give BANDS keys of BAND_ROWS samples each; the same samples, folded into a bitmap by
parity, form the odd sketch, whose XOR population count estimates the similarity of a candidate pair without its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from . import textarrays as ta
from .components import components
from .staging import staged

BANDS, BAND_ROWS = 35, 7
SAMPLES = BANDS * BAND_ROWS
SKETCH_BITS = 1024
#: Links have 100 * intersection >= min_percent * union, by default this many.
MIN_PERCENT = 85
#: Two sets just similar enough for a link share no band with at most this probability.
MAX_MISSED = 2e-6
#: An estimate below this is over six standard deviations from a link of LEAST_PERCENT or more.
MIN_ESTIMATE, LEAST_PERCENT = 0.62, 80
#: Up to this many sets in a bucket are paired directly, more by what each differs in from the bucket's hub.
WIDE_BUCKET = 16
FILTER_BITS = 1 << 21
#: Counters of the changes from references, and those of a slice that is added up in one place.
COUNTERS, SLICE = 1 << 20, 1 << 14
_BLOCK = 1 << 15


def _multipliers() -> np.ndarray:
    return (ta.mix(np.arange(SAMPLES, dtype=np.uint64), 5) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def samples(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash samples (texts x SAMPLES) of non-empty sets given end to end."""
    out = np.empty((len(bounds) - 1, SAMPLES), np.uint32)
    short = (sets >> np.uint64(32)).astype(np.uint32)
    factors = _multipliers()
    first = 0
    while first < len(out):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + _BLOCK, "right")) - 1)
        last = min(last, len(out))
        values = short[bounds[first]:bounds[last]]
        starts = bounds[first:last] - bounds[first]
        for k, factor in enumerate(factors):
            out[first:last, k] = np.minimum.reduceat(values * factor, starts)
        first = last
    return out


def band_rows(min_percent: int) -> int:
    """The samples of each band that its key takes: as many as MAX_MISSED allows, 7 at 85 percent and 5 at 80."""
    if not LEAST_PERCENT <= min_percent <= 100:
        raise ValueError(f"min_percent must be from {LEAST_PERCENT} to 100")
    return max(r for r in range(1, BAND_ROWS + 1) if (1 - (min_percent / 100) ** r) ** BANDS <= MAX_MISSED)


def band_keys(sampled: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    keys = np.zeros((len(sampled), BANDS), np.uint64)
    for row in range(rows):
        keys = ta.mix(keys + sampled[:, row::BAND_ROWS], row)
    return ta.mix(keys + np.arange(BANDS, dtype=np.uint64), 9)


def odd_sketches(sampled: np.ndarray) -> np.ndarray:
    """Parity bitmaps, SKETCH_BITS bits as 64-bit words: each (position, sample) flips one bit."""
    place = ta.mix(sampled.astype(np.uint64) * np.uint64(SAMPLES) + np.arange(SAMPLES, dtype=np.uint64), 13) % np.uint64(SKETCH_BITS)
    flat = place.astype(np.int64) + np.arange(len(sampled))[:, None] * SKETCH_BITS
    parity = (np.bincount(flat.ravel(), minlength=len(sampled) * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity.reshape(len(sampled), SKETCH_BITS), axis=1).view(np.int64)


def _lists(values: np.ndarray, present: np.ndarray, width: int) -> pa.Array:
    """One list of ``width`` values for each present text, null for the others."""
    ends = np.concatenate([[0], np.cumsum(present * width)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel().view(np.int64)), mask=pa.array(~present))


def signature_batches(batches: Iterator[pa.Array], band_size: int = BAND_ROWS) -> Iterator[pa.Array]:
    for text in batches:
        done = []
        for chunk in ta.chunks(text):
            sets, bounds = ta.shingle_sets(chunk)
            sizes = np.diff(bounds)
            present = sizes > 0
            own = np.concatenate([[0], np.cumsum(sizes[present])])
            sampled = samples(sets, own)
            digest = np.stack([ta.sums(ta.mix(sets, seed), own) for seed in (3, 4)], axis=1) if len(sampled) else np.zeros((0, 2), np.uint64)
            name = np.zeros((chunk.texts, 2), np.uint64)
            name[present] = digest
            node = pa.array([bytes(n) if p else None for n, p in zip(name.astype(">u8").view("V16").ravel().tolist(), present.tolist())],
                            pa.binary())
            done.append(pa.StructArray.from_arrays(
                [pa.array(sizes.astype(np.int64)), node, _lists(band_keys(sampled, band_size), present, BANDS),
                 _lists(odd_sketches(sampled), present, SKETCH_BITS // 64)],
                names=["n_shingles", "node", "bands", "sketch"]))
        yield pa.concat_arrays(done) if done else pa.array([], pa.struct(
            [("n_shingles", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))]))


def signature(text: Column, min_percent: int = MIN_PERCENT) -> Column:
    band_size = band_rows(min_percent)

    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return signature_batches(batches, band_size)

    return arrow_udf(signed, "struct<n_shingles: bigint, node: binary, bands: array<bigint>, sketch: array<bigint>>")(text)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two odd sketches: the XOR has n/2 (1 - e^(-2d/n)) bits for d differing samples."""
    odd = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    share = 1 - 2 * odd / F.lit(SKETCH_BITS)
    differing = -F.lit(SKETCH_BITS / 2) * F.log(F.greatest(share, F.lit(1e-9)))
    return 1 - differing / F.lit(2 * SAMPLES)


def _set_pairs(batch: pa.RecordBatch, kept: dict[str, tuple[bytes | None, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The whole shingle sets of each pair (a, b, text_a, text_b); ``kept`` holds the last set of either side."""
    for i, names in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
        for side, name in zip("ab", names):
            if side not in kept or kept[side][0] != name:
                kept[side] = (name, ta.shingle_sets(next(ta.chunks(batch.column(f"text_{side}").slice(i, 1))))[0])
        yield kept["a"][1], kept["b"][1]


def confirm_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of intersection and union of the whole shingle sets of pairs."""
    kept: dict = {}
    for batch in batches:
        common, united = [], []
        for x, y in _set_pairs(batch, kept):
            common.append(len(np.intersect1d(x, y, assume_unique=True)))
            united.append(len(x) + len(y) - common[-1])
        yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(united, pa.int64())],
                              names=["a", "b", "common", "united"])


def change_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs of a set and its hub: the sum of their sizes, and the shingles that only one of them has."""
    kept: dict = {}
    for batch in batches:
        size, both, ends, changes = [], [], [0], [np.zeros(0, np.uint64)]
        for x, y in _set_pairs(batch, kept):
            changes.append(np.setxor1d(x, y, assume_unique=True))
            size.append(len(x))
            both.append(len(x) + len(y))
            ends.append(ends[-1] + len(changes[-1]))
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(changes).view(np.int64)))
        yield pa.record_batch([batch.column("a"), batch.column("b"), batch.column("component"), pa.array(size, pa.int64()),
                               pa.array(both, pa.int64()), listed], names=["node", "hub", "component", "size", "both", "changes"])


def _counters(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The changes of each set, and their counters: those of another reference are others."""
    for hub, changes in zip(batch.column("hub").to_pylist(), batch.column("changes")):
        values = changes.values.to_numpy().view(np.uint64)
        yield values, (ta.mix(values + np.frombuffer(hub[:8], np.uint64), 17) % np.uint64(COUNTERS)).astype(np.int64)


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets of a task have a change, up to 255, in slices of one byte for each counter."""
    counts = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for _, at in _counters(batch):
            np.add.at(counts, at, 1)
    slices = np.minimum(counts, 255).astype(np.uint8).reshape(-1, SLICE)
    used = np.flatnonzero(slices.any(axis=1))
    yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array([slices[i].tobytes() for i in used], pa.binary())], names=["slice", "counts"])


def add_slices(table: pa.Table) -> pa.Table:
    total = np.zeros(SLICE, np.int64)
    for counts in table.column("counts"):
        total += np.frombuffer(counts.as_py(), np.uint8)
    return pa.table({"slice": table.column("slice").slice(0, 1), "counts": pa.array([np.minimum(total, 255).astype(np.uint8).tobytes()], pa.binary())})


def _change_counts(found: DataFrame) -> np.ndarray:
    """For each counter how many sets have a change of it, up to 255: never less than the sets that have one of these changes.

    Tasks count for themselves; what they give does not grow with their rows, and nor does the table, one byte a counter.
    """
    slices = found.select("hub", "changes").mapInArrow(count_batches, "slice int, counts binary").groupBy("slice").applyInArrow(
        add_slices, "slice int, counts binary").collect()  # at most COUNTERS / SLICE rows
    table = np.zeros((COUNTERS // SLICE, SLICE), np.uint8)
    for row in slices:
        table[row["slice"]] = np.frombuffer(row["counts"], np.uint8)
    return table.ravel()


def _prefixes(found: DataFrame, min_percent: int) -> DataFrame:
    """Of each set the changes, with their places, of which a link needs one in common: rare ones first, in one order for all
    sets of a reference. Changes that no other set has come before them and are not kept."""
    counts = _change_counts(found)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, changes, places = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i, ((values, at), size) in enumerate(zip(_counters(batch), batch.column("size").to_pylist())):
                sets = counts[at]
                place = np.arange(min(len(values), (100 - min_percent) * size // min_percent + 1))
                order = np.lexsort((values, sets))[:len(place)]
                shared = sets[order] > 1
                rows.append(np.full(int(shared.sum()), i))
                changes.append(values[order[shared]])
                places.append(place[shared])
            kept = batch.select(["hub", "node", "component", "size", "n", "near"]).take(pa.array(np.concatenate(rows)))
            yield pa.record_batch([*kept.columns, pa.array(np.concatenate(changes).view(np.int64)), pa.array(np.concatenate(places))],
                                  names=[*kept.schema.names, "change", "place"])

    return staged(found.mapInArrow(
        first, "hub binary, node binary, component binary, size bigint, n int, near boolean, change bigint, place bigint"), "prefixes")


def _likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) with their estimate, where it allows a link."""
    side = lambda name: sketches.select(F.col("node").alias(name), F.col("sketch").alias(f"sketch_{name}"))
    return (pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
            .select("a", "b", estimate(F.col("sketch_a"), F.col("sketch_b")).alias("estimate")).where(F.col("estimate") >= MIN_ESTIMATE))


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    side = lambda name: texts.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def _confirmed(pairs: DataFrame, texts: DataFrame, min_percent: int) -> DataFrame:
    """Pairs with the exact sizes of intersection and union, and whether they are linked."""
    found = _with_texts(pairs.select("a", "b"), texts).mapInArrow(confirm_batches, "a binary, b binary, common bigint, united bigint")
    return staged(found.withColumn("linked", 100 * F.col("common") >= min_percent * F.col("united")), "confirmed")


def _hubs(buckets: DataFrame) -> DataFrame:
    """The hub of each bucket (key, hub): the member that meets most others over all its buckets.

    In a group of copies of one original with few changes each, that is the original, to which all are closer than to
    one another.
    """
    meets = buckets.groupBy("node").agg(F.sum("size").alias("meets"))
    return staged(buckets.join(meets, "node").groupBy("key").agg(F.max(F.struct("meets", F.col("node").alias("hub")))["hub"].alias("hub")), "hubs")


def _several(rows: DataFrame) -> DataFrame:
    """Rows (key, node, component) of buckets that hold more than one component, with the bucket's size."""
    parts = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("key").agg(F.count(F.lit(1)).alias("components"), F.sum("n").alias("size"))
    return rows.join(mixed.where("components > 1").select("key", "size"), "key")


def _bucket_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of different components that share a bucket of at most WIDE_BUCKET sets."""
    return rows.alias("x").join(rows.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node"))
                                & (F.col("x.component") != F.col("y.component"))).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _families(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """(node, component, hub): one reference set for all buckets whose hubs are in one component, so that a set has few rows
    however many buckets it is in, and the members of a bucket have one in common. The reference is the hub of most buckets."""
    placed = staged(rows.join(hubs, "key").select("key", "node", "component", "hub"), "placed")
    own = placed.where("node = hub").select("key", F.col("component").alias("family"), "hub")
    most = own.groupBy("family", "hub").agg(F.count(F.lit(1)).alias("n")).groupBy("family").agg(F.max(F.struct("n", "hub"))["hub"].alias("hub"))
    references = staged(own.select("key", "family").join(most, "family").select("key", "hub"), "references")
    return placed.select("key", "node", "component").join(references, "key").select("node", "component", "hub").distinct()


def _change_pairs(rows: DataFrame, hubs: DataFrame, texts: DataFrame, min_percent: int) -> DataFrame:
    """Pairs of different components that share a bucket, found by how they differ from a reference: every link is among them.

    Let a set's changes be the shingles that it or the reference has, not both. The difference of two sets is that of
    their changes, so a link needs so many changes in common that the rarest few of each must share one: a set-similarity
    join of short sets, with prefix and position filters, each change ordered by how many sets of the family have it, as far as a
    bounded table of counters tells. That holds for any reference and any order. Two linked sets without a common change are both linked with the reference, and meet there.
    """
    apart, whole = 100 - min_percent, 100 + min_percent
    members = _families(rows, hubs).where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"), "component")
    found = _with_texts(members, texts).mapInArrow(
        change_batches, "node binary, hub binary, component binary, size bigint, both bigint, changes array<bigint>")
    found = staged(found.withColumn("n", F.size("changes")).withColumn("near", whole * F.col("n") <= apart * F.col("both")), "changes")

    prefixes = _prefixes(found, min_percent)
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    left = F.least(x("n") - x("place"), y("n") - y("place"))
    enough = 2 * whole * left >= whole * (x("n") + y("n")) - apart * (x("size") + y("size"))
    met = prefixes.where("not near").alias("x").join(
        prefixes.alias("y"), (x("hub") == y("hub")) & (x("change") == y("change")) & (x("component") != y("component")) & enough)
    return met.select(F.least(x("node"), y("node")).alias("a"), F.greatest(x("node"), y("node")).alias("b")).union(
        found.where("near").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")))


def _maybe_in(wanted: DataFrame, column: str) -> Column:
    """Whether a value may be among those of ``wanted``: a bitmap of FILTER_BITS bits, so of fixed size, tested before the
    shuffle of a join. The more values are wanted the less it filters; it never loses one."""
    place = F.xxhash64(column).bitwiseAND(FILTER_BITS - 1)
    words = wanted.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(63).cast("int"))).alias("bits")).collect()
    bitmap = np.zeros(FILTER_BITS >> 6, np.int64)
    for r in words:  # at most FILTER_BITS / 64 rows
        bitmap[r["word"]] = r["bits"]

    def test(places: pa.Array) -> pa.Array:
        p = places.to_numpy(zero_copy_only=False)
        return pa.array((bitmap[p >> 6] >> (p & 63)) & 1 == 1)

    return arrow_udf(test, "boolean")(place)


def near_duplicates(docs: DataFrame, min_percent: int = MIN_PERCENT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, digest (md5 of the text), n_shingles, node (name of the set), component
    (name of the group; both null for texts without words) and component_id (the group's smallest doc_id; the own one
    for texts without words, which are linked with nothing).

    Equal rows and copies share a node. Null ids count as larger than all others: a group of null ids only has a null
    component_id. An empty table gives an empty result. Sets are linked from a Jaccard similarity of ``min_percent`` on,
    which is 80 or more.
    """
    rows = docs.select("doc_id", "text")
    signed = staged(rows.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"), signature(F.col("text"), min_percent).alias("s"))
                    .select("doc_id", "digest", "s.*"), "signatures")
    sketches = staged(signed.where("node is not null").groupBy("node").agg(
        F.min(F.struct("digest", "n_shingles", "bands", "sketch")).alias("s")).select("node", "s.*"), "nodes")

    keyed = sketches.select("node", F.explode("bands").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = staged(keyed.join(sizes, "key"), "buckets")

    shared = sketches.join(buckets.select("node").distinct(), "node", "left_semi").select("digest", "node")
    digest = F.unhex(F.md5("text"))
    named = rows.where(F.col("text").isNotNull()).select(digest.alias("digest"), "text")
    texts = staged(named.where(_maybe_in(shared, "digest")).join(shared, "digest")
                   .groupBy("node").agg(F.min("text").alias("text")), "texts")

    # First each set with the most similar hub of its buckets.
    hubs = _hubs(buckets)
    near = _likely(buckets.join(hubs, "key").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")), sketches)
    first = _confirmed(near.groupBy("a").agg(F.max(F.struct("estimate", "b"))["b"].alias("b")), texts, min_percent)
    links = first.where("linked")
    grouped = components(links)

    # Then pairs of sets that share a bucket and are still in different components.
    unsettled = staged(_several(buckets.select("key", "node").join(grouped, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"))), "open")
    wide = F.col("size") > WIDE_BUCKET
    pairs = _bucket_pairs(unsettled.where(~wide)).union(_change_pairs(unsettled.where(wide), hubs, texts, min_percent))
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _confirmed(_likely(pairs, sketches).join(tried, ["a", "b"], "left_anti"), texts, min_percent).where("linked")
    if more.limit(1).count():
        grouped = components(links.union(more))

    lowest = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    members = lowest.join(grouped, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    groups = staged(members, "members")
    named = groups.join(groups.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component").select(
        "node", "component", "component_id")
    return signed.select("doc_id", "digest", "n_shingles", "node").join(named, "node", "left").select(
        "doc_id", "digest", "n_shingles", "node", "component",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, min_percent: int = MIN_PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near-copies: of the smallest doc_id, then the smallest md5 of the text.

    Texts without words all stay. Of rows that repeat an id and text the one whose other columns come first as JSON stays.
    """
    grouped = near_duplicates(docs.select("doc_id", "text"), min_percent)
    name = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_name"), "digest"]
    chosen = grouped.where("node is not null").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("c")).select("c.doc_id", "c.digest").select(*name)
    rows = docs.select(F.struct("*").alias("document")).withColumn("digest", F.unhex(F.md5(F.coalesce("document.text", F.lit(""))))).withColumn(
        "_name", F.coalesce(F.col("document.doc_id").cast("string"), F.lit("")))
    words = F.coalesce(F.col("document.text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    others = F.to_json(F.col("document").dropFields("text"))
    single = rows.where(words).join(chosen, ["_name", "digest"]).groupBy("_name", "digest").agg(
        F.min_by("document", others).alias("document")).select("document.*")
    return single.union(rows.where(~words).select("document.*"))

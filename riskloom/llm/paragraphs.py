"""Repeated passages by MinHash banding of paragraphs.

A paragraph is a line of ``LINE_WORDS`` words or more. So that a passage is
found inside longer paragraphs too, every text is also cut into overlapping
blocks of ``BLOCK_WORDS`` words that begin at anchors: a word begins a block
if the hash of the two words from it on is the least of some ``GAP``
consecutive ones, which depends on the passage alone. A shared passage of
``BLOCK_WORDS + GAP`` words or more therefore holds a whole block that is
equal in all its copies (a band of one row: the block itself).

Paragraphs get ``BANDS`` bands of ``ROWS`` MinHash values, tuned so that a
pair at the threshold meets with a probability of 0.997. Those that meet a
bucket's least member are verified by the exact Jaccard similarity of their
word shingles; those that stay outside its component are compared with
everybody in their bucket, in blocks of bounded size that return a row a member. Equal blocks and linked paragraphs form components; in each,
the first occurrence stays and the others are removals.

One exchange deals all keys out; buckets are streamed, never gathered. Texts
are fetched only for paragraphs that met an unequal one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored, text_or_empty
from riskloom.llm.components import components
from riskloom.llm.wordsets import SHINGLE, forest, mix, rolling, shingles, signatures, similar_pairs, window_hashes, window_least
from riskloom.llm.wordsets import _words as word_hash
from riskloom.session import ship_package

LINE_WORDS = 25
BLOCK_WORDS = 30
GAP = 20
BANDS = 8
ROWS = 3
SIMILAR = 0.8
BLOCK = 128     # paragraphs in a block of exact comparisons

UNITS = "key long, unit long, line boolean, d1 long, start int, end int"
_NAMES = [x.split()[0] for x in UNITS.split(", ")]
_ROW = mix(np.arange(101, 101 + ROWS, dtype=np.uint64)) | np.uint64(1)
_BAND = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def _word_spans(raw: bytes) -> np.ndarray:
    """(start, end) bytes of every word."""
    codes = np.frombuffer(raw, np.uint8)
    inside = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edge.reshape(-1, 2)


def anchors(words: np.ndarray, gap: int = GAP) -> np.ndarray:
    """Positions that hold the least two-word hash of some ``gap`` consecutive positions."""
    pairs = window_hashes(words, 2)
    if len(words) < 2 or len(pairs) < gap:
        return np.zeros(min(1, len(words)), np.int64)
    least = window_least(pairs, gap)
    # the greatest least of the windows that hold a position is its own hash only if it is the least of one
    edge = np.zeros(gap - 1, np.uint64)
    top = ~window_least(~np.concatenate([edge, least, edge]), gap)
    return np.flatnonzero(top == pairs)


def units(text: str) -> list[np.ndarray] | None:
    """Arrays of key, content hash, is a paragraph, start and end (bytes) of the units of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    spans = _word_spans(raw)
    n = len(spans)
    if n < min(LINE_WORDS, BLOCK_WORDS):
        return None
    words = np.fromiter(map(word_hash.__getitem__, raw.split()), np.uint64, n)
    at = anchors(words)
    at = at[at <= n - BLOCK_WORDS]
    out = [[rolling(words, BLOCK_WORDS, 0)[at], rolling(words, BLOCK_WORDS, 1)[at], np.zeros(len(at), bool),
            spans[at, 0], spans[at + BLOCK_WORDS - 1, 1]]] if len(at) else []
    breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
    bounds = np.concatenate([[0], np.searchsorted(spans[:, 0], breaks), [n]])
    long = np.flatnonzero(np.diff(bounds) >= LINE_WORDS)
    if len(long):
        first, last = bounds[long], bounds[long + 1]
        own = window_hashes(words)  # those within a line are its shingles
        inside = np.concatenate([np.arange(a, b - SHINGLE + 1) for a, b in zip(first, last)])
        starts = np.concatenate([[0], np.cumsum(last - first - SHINGLE + 1)[:-1]])
        sig = signatures(own[inside], starts, BANDS * ROWS).reshape(len(long), BANDS, ROWS)
        keys = mix((sig * _ROW[None, None, :]).sum(axis=2, dtype=np.uint64) + _BAND[None, :])
        total = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(mix(words + np.uint64(1)) * (np.arange(n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)))])
        place = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(mix(words + np.uint64(1)))])
        # the sum of words times their place in the line, and the sum of words
        content = (total[last] - total[first]) - (place[last] - place[first]) * (first.astype(np.uint64) * np.uint64(2))
        content = mix(content ^ mix(place[last] - place[first]) + (last - first).astype(np.uint64))
        out.append([keys.ravel(), np.repeat(content, BANDS), np.ones(len(long) * BANDS, bool),
                    np.repeat(spans[first, 0], BANDS), np.repeat(spans[last - 1, 1], BANDS)])
    return [np.concatenate(c) for c in zip(*out)] if out else None


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            made = [(d1, found) for d1, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) if (found := units(t))]
            if made:
                key, unit, line, a, b = (np.concatenate(c) for c in zip(*(found for _, found in made)))
                d1 = np.repeat(np.array([d for d, _ in made], np.int64), [len(found[0]) for _, found in made])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(unit.view(np.int64)), pa.array(line), pa.array(d1),
                                                  pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], _NAMES)


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, shingles) of paragraphs, cut from their documents."""
    for batch in batches:
        items = [shingles(t.encode("utf-8", "surrogatepass")[a:b].decode("utf-8", "surrogatepass")).tobytes()
                 for t, a, b in zip(*(batch.column(c).to_pylist() for c in ("text", "start", "end")))]
        yield pa.RecordBatch.from_arrays([batch.column("unit"), pa.array(items, pa.binary())], ["unit", "items"])


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(both >= threshold * (len(x) + len(y) - both) - 1e-9)
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])
    return run


def _verify_blocks(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = []
            for members in batch.column(0).to_pylist():
                members.sort(key=lambda m: not m["ask"])
                sets = [np.frombuffer(m["items"], np.uint64) for m in members]
                near = similar_pairs(sets, threshold, sum(m["ask"] for m in members))
                edges += [(members[root]["unit"], m["unit"]) for m, root in zip(members, forest(near)) if m["unit"] != members[root]["unit"]]
            columns = list(zip(*edges)) or [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])
    return run


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged removals and kept originals of a document, in code points."""
    for batch in batches:
        rows = []
        for doc, d1, text, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "d1", "text", "found"))):
            raw = text.encode("utf-8", "surrogatepass")
            points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
            place = lambda spans: [(int(points[a]), int(points[b])) for a, b in _merge(spans)]
            gone = place([(f["start"], f["end"]) for f in found if not f["first"]])
            stay = place([(f["start"], f["end"]) for f in found if f["first"]])
            show = lambda spans: ",".join(f"{a}:{b}" for a, b in spans)
            rows.append((doc, d1, show(gone), show(stay), sum(b - a for a, b in gone), len(found)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32())
        columns = list(zip(*rows)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         ["doc_id", "d1", "removed", "originals", "removed_chars", "passages"])


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    own = [F.col(doc_id).isNull(), F.col(doc_id).cast("long"), text_or_empty(text)]
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(*own).alias("d1"), text_or_empty(text).alias("text"))


def meetings(rows: DataFrame) -> DataFrame:
    """``key, unit, line, d1, start, end, low``: units whose key occurs in two
    documents, and the least unit of the key. Stored once."""
    cut = rows.select("d1", "text").mapInArrow(_unit_batches, UNITS).repartition("key")
    # One exchange serves the aggregation and the join, if both read the same columns: so
    # the aggregation looks at all of them (a line is no block, and starts before it ends).
    ends = cut.groupBy("key").agg(F.min("d1").alias("from"), F.max("d1").alias("to"), F.min("unit").alias("low"),
                                  F.min(F.col("end") - F.col("start")).alias("size"), F.bool_or("line").alias("lines"), F.bool_and("line").alias("all"))
    ends = ends.filter("from < to and size > 0 and lines = all").select("key", "low")
    return stored(cut.join(ends.hint("shuffle_hash"), "key"), "meetings")


def links(rows: DataFrame, met: DataFrame, threshold: float) -> DataFrame:
    """Verified pairs ``a, b`` of unlike paragraphs, by their content hashes."""
    pairs = stored(met.filter("line and unit != low").select(F.col("low").alias("a"), F.col("unit").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("unit")).distinct()
    where = met.filter("line").join(wanted, "unit").groupBy("unit").agg(F.min(F.struct("d1", "start", "end")).alias("at"))
    where = where.select("unit", "at.d1", "at.start", "at.end")
    texts = rows.select("d1", "text").join(where.hint("shuffle_hash"), "d1")
    items = stored(texts.mapInArrow(_bytes_of, "unit long, items binary").groupBy("unit").agg(F.first("items").alias("items")), "items")
    both = pairs.join(items.select(F.col("unit").alias("a"), F.col("items").alias("x")), "a") \
        .join(items.select(F.col("unit").alias("b"), F.col("items").alias("y")), "b")
    found = stored(both.mapInArrow(_verify(threshold), "a long, b long"), "links")
    return stored(found.union(_outside(met, found, items, threshold)), "links")


def _outside(met: DataFrame, found: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """Links ``a, b`` of paragraphs outside the component of their bucket's least one to any other of the bucket."""
    label = components(found).select(F.col("node").alias("unit"), F.col("component").alias("label"))
    named = stored(met.filter("line").select("key", "unit").distinct().join(label, "unit", "left")
                   .withColumn("label", F.coalesce("label", "unit")), "named")
    least = named.groupBy("key").agg(F.min(F.struct("unit", "label"))["label"].alias("done"), F.count(F.lit(1)).alias("size"),
                                     F.min("label").alias("from"), F.max("label").alias("to"))
    # two members have met already
    mixed = named.join(least.filter("size > 2 and from < to"), "key").withColumn("ask", F.col("label") != F.col("done"))
    mixed = stored(mixed.select("key", "unit", "size", "ask", F.xxhash64("unit", F.lit(9)).alias("hash")), "mixed")
    askers = mixed.filter("ask").groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("askers"))
    dealt = mixed.join(askers, "key").withColumn("parts", F.ceil(F.col("size") / BLOCK).cast("int"))
    # a group (key, k, p) holds the k-th block of those who ask and the p-th part of everybody
    own, part = F.pmod("hash", "askers").cast("int"), F.pmod("hash", "parts").cast("int")
    asked = dealt.filter("ask").select("key", "unit", "ask", own.alias("k"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"))
    heard = dealt.select("key", "unit", F.lit(False).alias("ask"), F.explode(F.sequence(F.lit(0), F.col("askers") - 1)).alias("k"), part.alias("p"))
    groups = asked.unionByName(heard).join(items, "unit").groupBy("key", "k", "p").agg(F.collect_list(F.struct("ask", "unit", "items")).alias("members"))
    return groups.select("members").mapInArrow(_verify_blocks(threshold), "a long, b long").distinct()


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILAR) -> DataFrame:
    """One row for each document that shares a passage with another.

    ``doc_id, d1, removed, originals, removed_chars, passages``: spans
    ``start:end`` (code points, end exclusive, merged, comma-joined) to be
    removed, spans that stay because they are the first of their component
    (by smallest doc_id, null ids last), and how many units were found.
    Words are set apart by ASCII white space. A passage must be in two
    different documents: equal rows are one document, each with its row. A
    null text is empty; texts and passages shorter than a unit have no rows; an
    empty table gives none; other columns are ignored. Texts are used whole.
    """
    ship_package(docs.sparkSession)
    rows = _rows(docs, doc_id, text)
    met = meetings(rows)
    named = components(links(rows, met, threshold))
    lines = met.filter("line").select("unit", "d1", "start", "end").distinct()
    lines = lines.join(named.withColumnRenamed("node", "unit"), "unit", "left").withColumn("component", F.coalesce("component", "unit"))
    blocks = met.filter("not line").select("unit", "d1", "start", "end").withColumn("component", F.col("unit"))
    spots = lines.withColumn("line", F.lit(True)).unionByName(blocks.withColumn("line", F.lit(False))).distinct()
    order = rows.select("d1", "doc_id").distinct()
    placed = stored(spots.join(order, "d1"), "spots")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "d1", "start")
    # a component must span two documents, too
    first = placed.groupBy("line", "component").agg(F.min(place).alias("at"), F.min("d1").alias("from"), F.max("d1").alias("to")).filter("from < to")
    judged = placed.join(first, ["line", "component"]).select("d1", "start", "end", F.col("at.d1").alias("o"), F.col("at.start").alias("s"))
    judged = judged.withColumn("first", (F.col("d1") == F.col("o")) & (F.col("start") == F.col("s")))
    per_doc = judged.groupBy("d1").agg(F.collect_list(F.struct("start", "end", "first")).alias("found"))
    return rows.join(per_doc.hint("shuffle_hash"), "d1").mapInArrow(
        _documents, "doc_id long, d1 long, removed string, originals string, removed_chars long, passages int")


def strip(text: str, removed: str) -> str:
    """A text without the spans of :func:`repeated_passages`."""
    out, at = [], 0
    for a, b in (map(int, s.split(":")) for s in removed.split(",") if s):
        out.append(text[at:a])
        at = b
    return "".join([*out, text[at:]])

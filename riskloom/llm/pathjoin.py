"""Jaccard self-join of word-shingle sets by chosen paths.

Documents with equal sets are one class from the start. A class is embedded
as the 64 tokens of its MinHash signature. In each of ``RUNS`` runs a bucket
splits: every token is chosen or not by a hash of the bucket's path and the
token, so that about 1.25 tokens of a set are chosen, and the set goes to the
child bucket of each; two similar sets share children in proportion to their
similarity. Buckets of up to ``SMALL`` sets are compared by brute force on
their signatures; larger ones split again, up to ``DEPTH`` times, after which
all members are compared with the least one, and those unlike it with
everybody, in blocks. Runs repeat until a pair at the threshold is missed
with the probability ``1 - RECALL`` even if all its buckets split ``DEPTH`` times.

Pairs that look alike (estimate of ``LOOK`` or more) form coarse components.
In each, the exact Jaccard similarities of all members are computed from
their whole sets, in blocks of bounded size: a class of copies moves as one,
and a block of pairs returns one row a member, its count of links and one
edge, never its pairs. The result therefore has no false link, and misses
one only if chance kept both sets from one coarse component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored, text_or_empty
from riskloom.llm.components import components
from riskloom.llm.wordsets import HASHES, forest, mix, shingles, signature, similar_pairs
from riskloom.session import ship_package

SIMILAR = 0.8
LOOK = 0.58     # about four standard errors of 64 hashes below the threshold
RECALL = 0.999
SMALL = 48      # sets compared by brute force
DEPTH = 3       # splits of a bucket
BLOCK = 256     # sets in a block of exact comparisons
AT_ONCE = 64    # buckets whose members are held as Python objects at once
FIRST = 3       # runs after which sets that are tied already are told apart from the rest


def runs_for(recall: float, similar: float = SIMILAR, depth: int = 1) -> int:
    """Runs after which a pair shares a bucket after ``depth`` splits with this
    probability: at each split, a shared bucket passes on as many shared
    children as the pair's common tokens that are chosen."""
    chosen, missed = 1.0 / (similar * HASHES), 0.0
    for _ in range(depth):
        missed = (1 - chosen * (1 - missed)) ** (similar * HASHES)
    return math.ceil(math.log(1 - recall) / math.log(missed))


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sets = [shingles(t) for t in part.column(3).to_pylist()]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            whole = np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)
            signed = [signature(s).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], _longs(whole[:, 0]), _longs(whole[:, 1]), pa.array([len(s) for s in sets], pa.int32()),
                 pa.array(signed, pa.binary())], ["doc_id", "d1", "d2", "c1", "c2", "n", "sig"])


def _split(seeds: list[int] | None, chance: float):
    """(class, signature[, path]) -> (path, class) of every child bucket."""
    limit = np.uint64(min(2**64 - 1, int(chance * 2**64)))
    place = np.arange(HASHES, dtype=np.uint64) << np.uint64(32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            c1, c2 = (np.asarray(batch.column(i)) for i in (0, 1))
            tokens = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u4").reshape(-1, HASHES).astype(np.uint64) | place
            tokens = mix(tokens + np.uint64(1))
            paths = [np.full(len(c1), s, np.uint64) for s in seeds] if seeds else [np.asarray(batch.column(3)).view(np.uint64)]
            for path in paths:
                child = mix(tokens ^ mix(path)[:, None])
                row, col = np.nonzero(child < limit)
                # the draw itself is small by choice: scramble it again for the child's name
                yield pa.RecordBatch.from_arrays([_longs(mix(child[row, col] ^ path[row])), pa.array(c1[row]), pa.array(c2[row])],
                                                 ["path", "c1", "c2"])
    return run


def _alike(sigs: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.stack([(s[None, :] == others).mean(axis=1) >= LOOK for s in sigs])


EDGES = "a1 long, a2 long, b1 long, b2 long"
_EDGE = [x.split()[0] for x in EDGES.split(", ")]


def _edge_batch(edges: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*edges)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _EDGE)


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One edge for each member of a bucket that looks like another, to the
    least of its kind, unless both are known to be tied."""
    for batch in (b.slice(at, AT_ONCE) for b in batches for at in range(0, b.num_rows, AT_ONCE)):
        edges = []
        for members in batch.column(batch.schema.get_field_index("members")).to_pylist():
            sigs = np.frombuffer(b"".join(m["sig"] for m in members), "<u4").reshape(-1, HASHES)
            near = _alike(sigs, sigs)
            if "ask" in members[0]:  # only rows that ask are compared with the others
                ask = np.array([m["ask"] for m in members])
                near &= ask[:, None] | ask[None, :]
            np.fill_diagonal(near, False)
            for i, root in enumerate(forest(near)):
                # members of one label are tied together already
                if i != root and members[i]["label"] != members[root]["label"]:
                    edges.append((members[i]["c1"], members[i]["c2"], members[root]["c1"], members[root]["c2"]))
        yield _edge_batch(edges)


def _against_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        own, low = (np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(c)).to_pylist()), "<u4").reshape(-1, HASHES)
                    for c in ("sig", "low_sig"))
        near = (own == low).mean(axis=1) >= LOOK
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(5)] + [pa.array(near)],
                                         ["path", "c1", "c2", "low1", "low2", "near"])


def _dealt(members: DataFrame, sizes: DataFrame, key: list[str], block: int) -> DataFrame:
    """Members dealt into blocks of about ``block``, once for each pair of blocks
    of their group: adds ``i <= j`` and the member's own block ``at``."""
    known = members.join(sizes, key).withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    known = known.withColumn("at", F.pmod(F.xxhash64("c1", "c2", F.lit(7)), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (known.withColumn("other", every).withColumns({"i": F.least("at", "other"), "j": F.greatest("at", "other")})
            .drop("other", "blocks", "size"))


def coarse_edges(sets: DataFrame, runs: int, small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """Edges between classes (``c1, c2, sig``) that look alike.

    The first runs tie large groups together; the others report only what ties
    different groups, so the edges stay in proportion to the classes however
    often two members of a group meet."""
    seeds = [int(x) for x in mix(np.arange(1, runs + 1, dtype=np.uint64))]
    own = sets.withColumn("label", F.struct("c1", "c2"))
    found = _path_edges(own, seeds[:FIRST], small, depth)
    if runs > FIRST:
        label = components(found.select(F.struct(F.col("a1").alias("c1"), F.col("a2").alias("c2")).alias("a"),
                                        F.struct(F.col("b1").alias("c1"), F.col("b2").alias("c2")).alias("b")))
        label = label.select(F.col("node.c1").alias("c1"), F.col("node.c2").alias("c2"), F.col("component").alias("tied"))
        known = stored(own.join(label, ["c1", "c2"], "left").withColumn("label", F.coalesce("tied", "label")).drop("tied"), "labelled")
        found = found.union(_path_edges(known, seeds[FIRST:], small, depth))
    return found


def _path_edges(sets: DataFrame, seeds: list[int], small: int, depth: int) -> DataFrame:
    """Edges of some runs between classes (``c1, c2, sig, label``)."""
    chance = 1.0 / (SIMILAR * HASHES)
    child = "path long, c1 long, c2 long"
    level = sets.select("c1", "c2", "sig").mapInArrow(_split(seeds, chance), child)
    found = None
    for step in range(depth):
        level = stored(level, "paths")
        sizes = level.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        met = stored(level.join(sizes, "path"), "met").join(sets.select("c1", "c2", "sig", "label"), ["c1", "c2"])
        few = met.filter(F.col("size") <= small).groupBy("path").agg(F.collect_list(F.struct("c1", "c2", "sig", "label")).alias("members"))
        edges = few.select("members").mapInArrow(_look, EDGES)
        found = edges if found is None else found.union(edges)
        many = stored(met.filter(F.col("size") > small), "many")
        if many.isEmpty():
            return stored(found.distinct(), "edges")
        if step < depth - 1:
            level = many.select("c1", "c2", "sig", "path").mapInArrow(_split(None, chance), child)
    # still large after the last split: all against the least one, the rest against all
    least = many.groupBy("path").agg(F.min(F.struct("c1", "c2", "sig")).alias("low"))
    pairs = many.join(least, "path").select("path", "c1", "c2", F.col("low.c1").alias("low1"), F.col("low.c2").alias("low2"),
                                            "sig", F.col("low.sig").alias("low_sig"))
    against = stored(pairs.mapInArrow(_against_least, "path long, c1 long, c2 long, low1 long, low2 long, near boolean"), "against")
    found = found.union(against.filter("near and not (c1 = low1 and c2 = low2)").select("c1", "c2", "low1", "low2"))
    unlike = against.filter("not near").groupBy("path").agg(F.count(F.lit(1)).alias("size"))
    # a group (path, k) holds the k-th block of those unlike the least one, and everybody in small parts
    asked = against.join(unlike, "path").withColumn("askers", F.ceil(F.col("size") / BLOCK).cast("int"))
    total = against.groupBy("path").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    asked = asked.join(total, "path").withColumn("hash", F.xxhash64("c1", "c2", F.lit(9)))
    spread = asked.select("path", "c1", "c2", "near", F.explode(F.when(
        ~F.col("near"), F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                                    lambda p: F.struct(F.pmod("hash", "askers").cast("int").alias("k"), p.alias("p"), F.lit(True).alias("ask"))))
        .otherwise(F.array().cast("array<struct<k:int,p:int,ask:boolean>>"))).alias("to"))
    heard = asked.select("path", "c1", "c2", "near", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("askers") - 1),
        lambda k: F.struct(k.alias("k"), F.pmod("hash", "parts").cast("int").alias("p"), F.lit(False).alias("ask")))).alias("to"))
    groups = (spread.union(heard).join(sets.select("c1", "c2", "sig", "label"), ["c1", "c2"]).groupBy("path", "to.k", "to.p")
              .agg(F.collect_list(F.struct("c1", "c2", "sig", "label", F.col("to.ask").alias("ask"))).alias("members")))
    found = found.union(groups.select("members").mapInArrow(_look, EDGES))
    return stored(found.filter("not (a1 = b1 and a2 = b2)").distinct(), "edges")


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            items = [shingles(t).tobytes() for t in part.column(part.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(items, pa.binary())], ["c1", "c2", "g1", "g2", "items"])


LINKS = "c1 long, c2 long, m1 long, m2 long, links long"


def _exact(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, j, members in zip(*(batch.column(k).to_pylist() for k in range(3))):
                members.sort(key=lambda m: m["at"])
                sets = [np.frombuffer(m["items"], np.uint64) for m in members]
                split = sum(m["at"] == i for m in members) if i < j else None
                near = similar_pairs(sets, threshold, split)
                for m, n, root in zip(members, near.sum(axis=1).tolist(), forest(near)):
                    if n:
                        rows.append((m["c1"], m["c2"], members[root]["c1"], members[root]["c2"], n))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["c1", "c2", "m1", "m2", "links"])
    return run


def exact_links(docs: DataFrame, classes: DataFrame, coarse: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """``c1, c2, m1, m2, links``: for each class in a block of pairs, how many
    it is linked to there and one class of its component."""
    texts = docs.select("d1", "d2", "text")
    members = coarse.join(classes.select("c1", "c2", F.col("at.d1").alias("d1"), F.col("at.d2").alias("d2")), ["c1", "c2"])
    found = texts.join(members.hint("shuffle_hash"), ["d1", "d2"]).dropDuplicates(["c1", "c2"])
    sets = stored(found.select("c1", "c2", "g1", "g2", "text")
                  .mapInArrow(_sets_of, "c1 long, c2 long, g1 long, g2 long, items binary"), "sets")
    sizes = sets.groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    dealt = _dealt(sets, sizes, ["g1", "g2"], block)
    groups = dealt.groupBy("g1", "g2", "i", "j").agg(F.collect_list(F.struct("at", "c1", "c2", "items")).alias("members"))
    return stored(groups.select("i", "j", "members").mapInArrow(_exact(threshold), LINKS), "links")


def join_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILAR,
                   recall: float = RECALL, small: int = SMALL, depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """One row a document: ``doc_id, class_id, links, d1, d2, first``.

    ``class_id`` is the smallest doc_id of all documents tied to it through
    similarities of ``threshold`` or more (null only if they have none);
    ``links`` counts the different sets of shingles that it is directly linked
    to (equal sets are one); ``d1, d2`` is a key of (doc_id, text), and
    ``first`` says whether that key is the least of its class. Words are set
    apart by ASCII white space, as they are; a text of fewer than five words
    has one shingle, all of them. A null text is empty; texts without words are
    one class. Repeated rows each get a row, all alike. An empty table gives no rows.
    Other columns are ignored. Texts are used whole.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    own = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text")]
    rows = rows.select("doc_id", F.xxhash64(*own).alias("d1"), F.xxhash64(F.lit(1), *own).alias("d2"), "text")
    made = stored(rows.mapInArrow(_embed, "doc_id long, d1 long, d2 long, c1 long, c2 long, n int, sig binary"), "embedded")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "d1", "d2")
    classes = stored(made.groupBy("c1", "c2").agg(F.min(order).alias("at"), F.first("sig").alias("sig")), "classes")
    edges = coarse_edges(classes.filter("sig is not null"), runs_for(recall, depth=depth), small, depth)
    named = components(edges.select(F.struct(F.col("a1").alias("c1"), F.col("a2").alias("c2")).alias("a"),
                                    F.struct(F.col("b1").alias("c1"), F.col("b2").alias("c2")).alias("b")))
    coarse = stored(named.select("node.c1", "node.c2", F.col("component.c1").alias("g1"), F.col("component.c2").alias("g2")), "coarse")
    links = exact_links(rows, classes, coarse, threshold, block)
    tied = components(links.select(F.struct("c1", "c2").alias("a"), F.struct(F.col("m1").alias("c1"), F.col("m2").alias("c2")).alias("b")))
    count = links.groupBy("c1", "c2").agg(F.sum("links").alias("links"))
    known = classes.select("c1", "c2", "at").join(tied.select("node.c1", "node.c2", "component"), ["c1", "c2"], "left")
    known = known.join(count, ["c1", "c2"], "left").withColumn("component", F.coalesce("component", F.struct("c1", "c2")))
    least = known.groupBy("component").agg(F.min("at").alias("least"))
    known = stored(known.join(least, "component").select("c1", "c2", "least", F.coalesce("links", F.lit(0)).cast("long").alias("links")), "known")
    return made.select("doc_id", "d1", "d2", "c1", "c2").join(known, ["c1", "c2"]).select(
        "doc_id", F.col("least.doc_id").alias("class_id"), "links", "d1", "d2",
        ((F.col("d1") == F.col("least.d1")) & (F.col("d2") == F.col("least.d2"))).alias("first"))


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with one document of each class, that of the smallest doc_id, all columns as they were."""
    judged = stored(join_documents(docs, doc_id, text, **how).filter("first").select("d1", "d2"), "first")
    own = [F.col(doc_id).cast("long").isNull(), F.col(doc_id).cast("long"), text_or_empty(text)]
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                        F.xxhash64(*own).alias("d1"), F.xxhash64(F.lit(1), *own).alias("d2"))
    twice = judged.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    kept = keyed.join(judged.distinct().hint("shuffle_hash"), ["d1", "d2"])
    if (twice or 0) > 1:  # the same row is stored more than once: one of them stays
        kept = kept.groupBy("d1", "d2").agg(F.first("row").alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])

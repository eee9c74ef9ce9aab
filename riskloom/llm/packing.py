"""Best-fit packing of token pieces into fixed-length sequences by minimum bin slack.

Documents are tokenised where they lie; one longer than a sequence is cut so
that only its first piece is short. Which lengths share a sequence depends
only on how many pieces there are of each length, a histogram of at most
``capacity`` numbers, whatever the corpus. From it the driver draws up the
plan: a sequence starts with the largest piece left; a subset-sum dynamic
programme over the lengths still available (one bit per reachable fill, in a
single integer) finds the fullest combination for the rest of it; that
combination is removed as often as the counts allow. Each piece's rank among
those of its length is known from a running count in its task plus the counts
of earlier tasks, so it finds its place with one small broadcast lookup. No
piece moves between tasks but for that join.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import stored
from riskloom.session import ship_package

CAPACITY = 2048
END_ID = 0           # closes every document
WORDS_KEPT = 1_500_000  # encodings remembered by a Python worker
TEXTS_AT_ONCE = 2048    # texts encoded at once,
BYTES_AT_ONCE = 8 << 20 # fewer if they are long
MARKS = ".,;:!?#*$%&"   # no letter joins one of these after it
#: Letters in every version of Unicode.
LETTERS = frozenset(c for c in map(chr, range(0x180)) if c.isalpha())

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"

_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes.

    The vocabulary's rules never join a lone space or newline between two
    non-space characters to what stands before it, so a text may be cut there
    and each part encoded alone; parts recur, and their ids are remembered,
    under the part without its leading space or with its leading newline.
    The parts of many texts are told apart by Arrow first, so that each of them is
    looked up once, and their ids are put together by Arrow too.
    """

    _cut = re.compile(r"(?<=\S)(?=[ \n]\S)")
    _other_space = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        (self.newline,) = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def parts(self, text: str) -> list[str] | str:
        """A beginning to be encoded by itself, and the parts after it; as a text
        with a space between them if no part holds one."""
        spaced = text.replace("\n", " \n")
        if text and ("  " in spaced or "\n " in spaced or text[0] in " \n" or text[-1] in " \n"
                     or any(c in text for c in self._other_space)):
            first, *rest = self._cut.split(text)
            return [first, *(p[1:] if p[0] == " " else p for p in rest)]
        return spaced

    def direct(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, dtype="<u4").tobytes() for c in coded]

    def learn(self, new: list[str]) -> None:
        """Encode parts that are not known yet."""
        # Marks after a letter at the end are a token or more of their own; what is left recurs more often.
        made, text, line, known = [], {}, [], self.known
        for p in new:
            begin = p.rstrip(MARKS)
            if begin is not p and begin and begin[-1] in LETTERS:
                made.append((p, begin, p[len(begin):]))
                p = begin
            if p in text or p in known:
                continue
            if p[0] != "\n":
                text[p] = " " + p
            elif len(p) > 1 and not p[1].isspace():  # a leading newline is a token of its own
                text[p] = p[1:]
                line.append(p)
            else:
                text[p] = p
        # words with no space but a leading one go together, set apart by newlines
        every = {*text.values()}
        plain, seen = list(every), "".join(text)
        if seen.count("\n") > len(line) or any(c in seen for c in [" ", *self._other_space]):
            plain = [t for t in every if len(w := t.split()) == 1 and len(w[0]) + (t[0] == " ") == len(t)]
        odd = [*every.difference(plain), *{m for _, _, m in made}, "\n"]
        ids = dict(zip(odd, self.direct(odd)))
        calls = [plain[at:at + 1000] for at in range(0, len(plain), 1000)]
        for words, raw in zip(calls, self.direct(["\n".join(w) for w in calls])):
            cuts = (4 * np.flatnonzero(np.frombuffer(raw, dtype="<u4") == self.newline)).tolist()
            ids.update(zip(words, [raw[x:y] for x, y in zip([0, *(c + 4 for c in cuts)], [*cuts, len(raw)])]))
        known.update(zip(text, map(ids.__getitem__, text.values())))
        known.update([(p, ids["\n"] + known[p]) for p in line])
        known.update([(p, known[begin] + ids[marks]) for p, begin, marks in made])

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        cut = [self.parts(t) for t in texts]
        simple = [k for k, c in enumerate(cut) if isinstance(c, str)]
        others = [k for k, c in enumerate(cut) if not isinstance(c, str)]
        lists = [pc.split_pattern(pa.array([cut[k] for k in simple], pa.string()), " "),
                 pa.array([cut[k] for k in others], pa.list_(pa.string()))]
        words = pa.chunked_array([x.flatten() for x in lists], pa.string())
        size = np.concatenate([pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in lists]).astype(np.int64)
        ends = size.cumsum()
        first = self.direct(words.take(pa.array(ends - size)).to_pylist())
        after = np.ones(len(words), dtype=bool)
        after[ends - size] = False
        rest = words.filter(pa.array(after)).combine_chunks().dictionary_encode()
        names = rest.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, names))
        if None in found:
            new = [p for p, ids in zip(names, found) if ids is None]
            if len(self.known) + len(new) > WORDS_KEPT:
                self.known = {}  # what was found stays in hand
            self.learn(new)
            found = [self.known[p] if ids is None else ids for p, ids in zip(names, found)]
        at = np.zeros(len(found) + 1, dtype=np.int32)
        np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4, out=at[1:])
        each = pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(found), dtype="<u4")))
        place = {k: i for i, k in enumerate([*simple, *others])}
        upto = np.concatenate([[0], (size - 1).cumsum()])  # words after the first
        for k in range(len(texts)):
            i = place[k]
            mine = each.take(rest.indices[int(upto[i]):int(upto[i + 1])]).flatten()
            yield first[i] + mine.to_numpy(zero_copy_only=False).tobytes()


def cut_points(length: int, capacity: int) -> list[int]:
    """Where the pieces of a document of ``length`` ids begin."""
    first = length % capacity or capacity
    return [0, *range(first, length, capacity)]


def _pieces(path: str, capacity: int, with_ids: bool, texts_at_once: int = TEXTS_AT_ONCE):
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            step = max(1, min(texts_at_once, BYTES_AT_ONCE * batch.num_rows // max(1, batch.column(1).nbytes)))
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                rows: list[tuple] = []
                ids_of: list[np.ndarray] = []
                texts = [t or "" for t in some.column(1).to_pylist()]
                for doc, ids in zip(some.column(0).to_pylist(), encoder.encode(texts)):
                    ids += end
                    starts = cut_points(len(ids) // 4, capacity)
                    for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids) // 4])):
                        own = ids[4 * a:4 * b]
                        rows.append((doc, k, a, b - a, zlib.crc32(own), part, seen[b - a]))
                        seen[b - a] += 1
                        if with_ids:
                            ids_of.append(np.frombuffer(own, dtype="<u4").astype("int32"))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
                if with_ids:
                    columns.append(pa.array(ids_of, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def fullest(counts: dict[int, int], room: int) -> Counter:
    """The multiset of available lengths with the largest sum up to ``room``;
    of equal sums, one that uses long pieces."""
    reach, mask = 1, (1 << room + 1) - 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, some = min(counts[length], room // length), 1
        while left:
            some = min(some, left)
            steps.append((length, some, reach))
            reach |= reach << length * some & mask
            left, some = left - some, some * 2
        if reach >> room & 1:
            break
    fill, used = reach.bit_length() - 1, Counter()
    for length, some, before in reversed(steps):
        if not before >> fill & 1:
            used[length] += some
            fill -= length * some
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(how many pieces of each length, how many sequences are filled so)."""
    left = Counter({x: n for x, n in counts.items() if n > 0})
    if left and not 0 < min(left) <= max(left) <= capacity:
        raise ValueError("every length must lie between 1 and the capacity")
    out = []
    for largest in sorted(left, reverse=True):
        while left[largest]:
            left[largest] -= 1
            chosen = fullest(left, capacity - largest)
            left[largest] += 1
            chosen[largest] += 1
            times = min(left[x] // n for x, n in chosen.items())
            for x, n in chosen.items():
                left[x] -= n * times
            out.append((dict(sorted(chosen.items(), reverse=True)), times))
    return out


def places(packed: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, pieces a sequence, offset
    of the first): where the pieces of a length go, by their rank among them."""
    rank, sequence, out = Counter(), 0, []
    for chosen, times in packed:
        offset = 0
        for length, n in chosen.items():
            out.append((length, rank[length], rank[length] + n * times, sequence, n, offset))
            rank[length] += n * times
            offset += n * length
        sequence += times
    return out


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Token pieces of every document, stored once; ``part`` and ``nth`` number
    the pieces of each length within the task that made them."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = PIECES + (", ids array<int>" if with_ids else "")
    return stored(rows.mapInArrow(_pieces(tokenizer, capacity, with_ids), schema), "pieces")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Packs whole documents (id 0 closes each) into sequences of ``capacity`` ids.

    Columns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``
    and, if asked for, ``ids``. A null or empty text is the closing id alone;
    a null doc_id stays null; repeated rows are packed as often as they occur;
    an empty table gives no pieces; other columns are ignored. Sequences have
    no gaps before their last piece.
    """
    spark = docs.sparkSession
    made = pieces(docs, tokenizer, capacity, with_ids)
    by_task = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # rows depend on the capacity alone, not on the corpus
    where = spark.createDataFrame(places(plan(counts, capacity)), "of long, a long, z long, seq long, n long, off long")
    ranked = made.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    found = ranked.join(F.broadcast(where), (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("a"))
                        & (F.col("rank") < F.col("z")))
    at = F.col("rank") - F.col("a")
    return found.select("doc_id", "piece", "start", "length", "ids_crc32",
                        (F.col("seq") + F.floor(at / F.col("n"))).cast("long").alias("sequence_id"),
                        (F.col("off") + at % F.col("n") * F.col("length")).alias("offset"),
                        *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids themselves, one row a sequence (needs ``with_ids``)."""
    items = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(items, lambda x: x["ids"])).alias("ids"))

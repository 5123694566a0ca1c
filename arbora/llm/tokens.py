"""Token ids of whole texts by a byte-level BPE vocabulary.

Each partition cuts its texts into words by the tokenizer's own pattern and encodes every word it has
not met before with one recursive DuckDB query: rows (word, position, token) join the merge table, each
word contracts its pair of lowest rank, again and again, until no word has a mergeable pair; ordered
aggregation then gives the ids of a word, and those of its words the ids of a text. All occurrences of
a word's lowest pair are contracted at once, leftmost first, which is what contracting the leftmost one
repeatedly comes to: a pair that holds a merged token is always of a later rank than the merge itself.

The merge table, of fixed size, is sent to the executors once. No shuffle; a partition's memory of
words is bounded and only saves work.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: White space as Unicode has it; the regex library's own \s has four control characters more.
_S = r"\t-\r \x85\xa0  -     　"
#: The published pattern of this family of byte-level tokenizers.
WORDS = rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
#: Words kept in memory by a worker, and new words encoded by one query.
MEMORY, AT_ONCE = 400_000, 20_000

_MERGE = """
WITH RECURSIVE t(w, pos, tok, open) AS (
  SELECT w, pos, tok, true FROM symbols
  UNION ALL
  SELECT w, pos, tok, open FROM (
    SELECT w, pos, CASE WHEN take THEN merged ELSE tok END AS tok, best IS NOT NULL AS open, coalesce(lag(take) OVER (PARTITION BY w ORDER BY pos), false) AS gone
    FROM (
      SELECT *, hit AND row_number() OVER (PARTITION BY w, hit, idx - nth ORDER BY pos) % 2 = 1 AS take
      FROM (
        SELECT *, row_number() OVER (PARTITION BY w, hit ORDER BY pos) AS nth
        FROM (
          SELECT *, coalesce(merged = best, false) AS hit
          FROM (
            SELECT p.w, p.pos, p.tok, p.idx, m.merged, min(m.merged) OVER (PARTITION BY p.w) AS best
            FROM (SELECT w, pos, tok, row_number() OVER (PARTITION BY w ORDER BY pos) AS idx, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nx FROM t WHERE open) p
            LEFT JOIN merges m ON m.l = p.tok AND m.r = p.nx))))
  ) WHERE NOT gone)
SELECT w, list(tok ORDER BY pos) AS ids FROM t WHERE NOT open GROUP BY w
"""


def vocabulary(path: str) -> tuple[bytes, list[int]]:
    """The merge table (l, r, merged; merged ids ascend with the rank) as Arrow bytes, and the ids of the 256 bytes."""
    model = json.load(open(path, encoding="utf-8"))["model"]
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [vocab[a + b] for a, b in pairs]
    if any(x >= y for x, y in zip(merged, merged[1:])):
        raise ValueError("ids of merges don't ascend with their ranks")
    t = pa.table({"l": pa.array([vocab[a] for a, _ in pairs], pa.int32()), "r": pa.array([vocab[b] for _, b in pairs], pa.int32()), "merged": pa.array(merged, pa.int32())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as w:
        w.write_table(t)
    # the usual printable stand-ins: bytes that print stand for themselves, the others follow from 256 on
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in, extra = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in stand_in:
            stand_in[b], extra = chr(extra), extra + 1
    return sink.getvalue().to_pybytes(), [vocab[stand_in[b]] for b in range(256)]


class Encoder:
    """Encodes words by the recursive query; one per worker and partition."""

    def __init__(self, merges: bytes, byte_ids: list[int]):
        import duckdb
        import regex

        self.find = regex.compile(WORDS).findall
        self.byte_ids = byte_ids
        self.known: dict[str, list[int]] = {}
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
        self.con.register("m", pa.ipc.open_stream(merges).read_all())
        self.con.execute("CREATE TABLE merges AS SELECT * FROM m")
        self.con.unregister("m")

    def learn(self, words: list[str]) -> None:
        for i in range(0, len(words), AT_ONCE):
            some = words[i : i + AT_ONCE]
            data = [x.encode("utf-8", "replace") for x in some]
            w = [k for k, b in enumerate(data) for _ in b]
            pos = [p for b in data for p in range(len(b))]
            tok = [self.byte_ids[x] for b in data for x in b]
            self.con.register("symbols", pa.table({"w": pa.array(w, pa.int32()), "pos": pa.array(pos, pa.int32()), "tok": pa.array(tok, pa.int32())}))
            out = self.con.sql(_MERGE).to_arrow_table()
            self.con.unregister("symbols")
            for k, ids in zip(out["w"].to_pylist(), out["ids"].to_pylist()):
                self.known[some[k]] = ids

    def words(self, texts: list[str | None]) -> list[list[str]]:
        cut = [self.find(t) if t else [] for t in texts]
        if len(self.known) > MEMORY:
            self.known.clear()
        new = list({w for ws in cut for w in ws if w not in self.known})
        self.learn(new)
        return cut

    def ids(self, texts: list[str | None]) -> list[list[int]]:
        return [[i for w in ws for i in self.known[w]] for ws in self.words(texts)]

    def counts(self, texts: list[str | None]) -> list[int]:
        return [sum(len(self.known[w]) for w in ws) for ws in self.words(texts)]


#: The encoder of this Python worker, kept from task to task.
_KEPT: dict[int, Encoder] = {}


def encoder(merges: bytes, byte_ids: list[int]) -> Encoder:
    if (k := hash((merges, tuple(byte_ids)))) not in _KEPT:
        _KEPT.clear()
        _KEPT[k] = Encoder(merges, byte_ids)
    return _KEPT[k]


def slices(texts: list[str | None], most: int = 3_000_000) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most so many characters, or one text."""
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t or "") > most:
            yield at, i
            at, size = i, 0
        size += len(t or "")
    if texts:
        yield at, len(texts)


def spread(df: DataFrame) -> DataFrame:
    """A few splits of small input are spread over the cluster; larger input keeps its own splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * cores else df.repartition(3 * cores)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = TOKENIZER, count_only: bool = False) -> DataFrame:
    """(key, ids array<int>), or (key, n_tokens int) with count_only. No special tokens; an empty list for
    empty and null texts; repeated rows keep their rows; other columns are not read."""
    merges, byte_ids = vocabulary(path)
    sent = docs.sparkSession.sparkContext.broadcast((merges, byte_ids))
    x = spread(docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("x")))
    kind = dict(x.dtypes)["k"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(*sent.value)
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in slices(texts):
                v = pa.array(enc.counts(texts[i:j]), pa.int32()) if count_only else pa.array(enc.ids(texts[i:j]), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), v], ["k", "v"])

    out = x.mapInArrow(run, f"k {kind}, v {'int' if count_only else 'array<int>'}")
    return out.select(F.col("k").alias(key), F.col("v").alias("n_tokens" if count_only else "ids"))

"""Byte-level BPE by recursive queries (operator 12).

Texts stay where they are read: no shuffle.  A task cuts its texts into units (a gap and the word behind
it), looks up the ids of the units it met lately, and has its own in-process DuckDB contract the others.
There a word is rows of ``(word, place, token)``; a recursive query joins neighbouring rows with the
merge table, contracts the pair of least rank in each word, the leftmost first, and ends when no pair is
left in any word.  Decoding joins token rows with the vocabulary and puts their bytes together with an
ordered aggregation.

A word whose bytes are one token is that token, merges or not.  In words of more than 64 bytes all places
of the least pair are contracted in one step where no later pair with the new token could come before it
(the merge table knows); otherwise only the leftmost.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordon.llm.idcache import KnownIds, Recent, gather, give_back
from cordon.llm.wordhash import SPACE, prefix_hash, span_hash

#: bytes of text that are cut into units together; a longer text is cut between units
PIECE = 1 << 20
#: words in the younger half of a cache
KEPT = 100_000
#: units in the younger half of a cache
KEPT_UNITS = 300_000
SHORT = 64
#: bytes of words that one query contracts
CONTRACTED = 30_000
#: token rows decoded by one query
ROWS = 1 << 18
#: white space beyond the six plain characters
_RARE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

#: words of up to 64 bytes; ``g`` is 64 times the word and the place in it
CONTRACT = """
WITH RECURSIVE steps AS (
  SELECT g, token, 0 AS step FROM start
  UNION ALL
  (
    WITH pairs AS (
      SELECT g, token, lead(g) OVER (ORDER BY g) AS next_g, lead(token) OVER (ORDER BY g) AS next_token FROM steps
    ),
    least AS (
      SELECT g >> 6 AS word, min((rank::BIGINT << 6) | (g & 63)) AS key, arg_min(next_g, (rank::BIGINT << 6) | (g & 63)) AS gone
      FROM pairs JOIN merges ON a = token AND b = next_token WHERE next_g >> 6 = g >> 6 GROUP BY g >> 6
    )
    SELECT s.g, CASE WHEN s.g & 63 = l.key & 63 THEN (l.key >> 6)::INTEGER ELSE s.token END, s.step + 1
    FROM steps s JOIN least l ON l.word = s.g >> 6 WHERE s.g <> l.gone
  )
),
ended AS (SELECT g >> 6 AS word, max(step) AS step FROM steps GROUP BY g >> 6)
SELECT word, list(token ORDER BY g) AS ids FROM steps s JOIN ended e ON e.word = s.g >> 6 AND e.step = s.step GROUP BY word ORDER BY word
"""

#: words of any length: all places of a word's least pair in one step, where that is safe
CONTRACT_LONG = """
WITH RECURSIVE steps AS (
  SELECT word, place, token, 0 AS step FROM start
  UNION ALL
  SELECT word, place, token, step FROM (
    WITH pairs AS (
      SELECT word, place, token, step, lead(token) OVER w AS follower, row_number() OVER w AS nth
      FROM steps WINDOW w AS (PARTITION BY word ORDER BY place)
    ),
    ranked AS (
      SELECT p.*, m.rank, m.safe, min(m.rank) OVER (PARTITION BY word) AS least
      FROM pairs p LEFT JOIN merges m ON m.a = p.token AND m.b = p.follower
    ),
    found AS (
      SELECT *, rank = least AS hit, min(CASE WHEN rank = least THEN place END) OVER (PARTITION BY word) AS leftmost,
             -- places of the least pair that touch, as in 'aaaa': every second one of such a run counts
             nth - row_number() OVER (PARTITION BY word, coalesce(rank = least, false) ORDER BY place) AS run
      FROM ranked WHERE least IS NOT NULL
    ),
    chosen AS (
      SELECT *, coalesce(hit AND CASE WHEN safe THEN (row_number() OVER (PARTITION BY word, hit, run ORDER BY place)) % 2 = 1
                                      ELSE place = leftmost END, false) AS joined
      FROM found
    )
    SELECT word, place, CASE WHEN joined THEN rank ELSE token END AS token, step + 1 AS step,
           coalesce(lag(joined) OVER (PARTITION BY word ORDER BY place), false) AS gone
    FROM chosen
  ) WHERE NOT gone
)
SELECT word, list(token ORDER BY place) AS ids
FROM (SELECT *, max(step) OVER (PARTITION BY word) AS last FROM steps) WHERE step = last GROUP BY word ORDER BY word
"""

DECODE = """
SELECT doc, string_agg(bytes, '' ORDER BY place) AS text
FROM tokens JOIN vocabulary ON tokens.token = vocabulary.token GROUP BY doc ORDER BY doc
"""


class Vocabulary:
    """The ranks of a file and one in-process database with its tables."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        # the same classes wherever the pattern runs
        self.pattern = regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1")
        self.db.execute("SET memory_limit = '400MB'")
        # bytes as the characters of the same number: text that any byte string has
        self.db.register("arrow_vocabulary", pa.table({"token": np.fromiter(self.ranks.values(), np.int32, len(self.ranks)),
                                                       "bytes": [w.decode("latin-1") for w in self.ranks]}))
        self.db.execute("CREATE TABLE vocabulary AS FROM arrow_vocabulary")
        self.db.unregister("arrow_vocabulary")
        self.single = np.array([self.ranks.get(bytes([x]), -1) for x in range(256)], np.int32)
        self.words, self.units = Recent(KEPT), KnownIds(KEPT_UNITS)
        self.has_merges = False

    def _add_merges(self) -> None:
        """Every pair of tokens that is a token: the merge table."""
        merges = [(self.ranks[w[:i]], self.ranks[w[i:]], rank) for w, rank in self.ranks.items()
                  for i in range(1, len(w)) if w[:i] in self.ranks and w[i:] in self.ranks]
        a, b, rank = (np.array(x, np.int32) for x in zip(*merges)) if merges else (np.zeros(0, np.int32),) * 3
        early = set(np.concatenate([a[a > rank], b[b > rank]]).tolist())
        self.db.register("arrow_merges", pa.table({"a": a, "b": b, "rank": rank, "safe": np.array([r not in early for r in rank.tolist()], bool)}))
        self.db.execute("CREATE TABLE merges AS FROM arrow_merges")
        self.db.unregister("arrow_merges")
        self.has_merges = True

    def contract(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as bytes of little-endian 32-bit integers."""
        if not self.has_merges:
            self._add_merges()
        data, sizes = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words], np.int64)
        token = self.single[data]
        if (token < 0).any():
            raise ValueError("the vocabulary lacks a byte of the text")
        word = np.repeat(np.arange(len(words), dtype=np.int64), sizes)
        place = np.arange(len(data), dtype=np.int64) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        short = int(sizes.max()) <= SHORT
        self.db.register("start", pa.table({"g": word * SHORT + place, "token": token} if short else {"word": word, "place": place, "token": token}))
        ids = self.db.sql(CONTRACT if short else CONTRACT_LONG).to_arrow_table().column("ids").combine_chunks()
        self.db.unregister("start")
        upto, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4")
        return [flat[i:j].tobytes() for i, j in zip(upto[:-1].tolist(), upto[1:].tolist())]

    def of_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each of ``words``, however many the cache keeps."""
        found: dict[bytes, bytes] = {}
        unknown = []
        for w in dict.fromkeys(words):
            ids = self.words.get(w)
            if ids is None and (rank := self.ranks.get(w)) is not None:
                ids = rank.to_bytes(4, "little")
                self.words.put(w, ids)
            if ids is None:
                unknown.append(w)
            else:
                found[w] = ids
        for some in ([w for w in unknown if len(w) <= SHORT], [w for w in unknown if len(w) > SHORT]):
            lo = 0
            while lo < len(some):  # about ``CONTRACTED`` rows a query, or one word
                hi, size = lo, 0
                while hi < len(some) and (hi == lo or size + len(some[hi]) <= 100_000):
                    size, hi = size + len(some[hi]), hi + 1
                for w, ids in zip(some[lo:hi], self.contract(some[lo:hi])):
                    self.words.put(w, ids)
                    found[w] = ids
                lo = hi
        return found

    def of_units(self, units: list[bytes]) -> list[bytes]:
        """Ids of each unit."""
        found: list[bytes] = []
        for lo in range(0, len(units), KEPT // 4):
            parts = [[m.encode() for m in self.pattern.findall(u.decode())] for u in units[lo:lo + KEPT // 4]]
            known = self.of_words([w for p in parts for w in p])
            found += [b"".join(map(known.__getitem__, p)) for p in parts]
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text."""
        out: list[list[bytes]] = [[] for _ in range(len(texts))]
        for owner, pieces in _gathered(texts):
            data = b"".join(pieces)
            raw = np.frombuffer(data, np.uint8)
            begins = np.cumsum([0, *map(len, pieces)])
            start, stop, piece = _units(raw, begins)
            if len(start) == 0:
                continue
            pre, pre2 = prefix_hash(raw), prefix_hash(raw, 1)
            code, distinct = pd.factorize(span_hash(pre, start, stop))
            where = np.empty(len(distinct), np.int64)
            where[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            second = span_hash(pre2, start, stop, 1)
            a, b = start[where].tolist(), stop[where].tolist()
            if np.array_equal(second, second[where][code]):
                pool, begin, sizes = self.units.ids_of(distinct, second[where], lambda new: self.of_units([data[a[i]:b[i]] for i in new.tolist()]))
            else:  # two units of one hash: each for itself
                code = np.arange(len(start))
                ids = self.of_units([data[i:j] for i, j in zip(start.tolist(), stop.tolist())])
                sizes = np.array([len(x) for x in ids], np.int64) >> 2
                pool, begin = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
            size = sizes[code]
            flat = gather(pool, begin[code], size).tobytes()
            per = np.cumsum(np.bincount(piece, weights=size, minlength=len(pieces)).astype(np.int64))
            for i, row in enumerate(owner):
                out[row].append(flat[4 * int(per[i - 1] if i else 0):4 * int(per[i])])
        return [b"".join(x) for x in out]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each row of ids."""
        out: list[list[bytes]] = [[] for _ in ids]
        owner, held, rows = [], [], 0

        def flush() -> None:
            token = np.concatenate(held)
            doc = np.repeat(np.arange(len(held), dtype=np.int32), [len(h) for h in held])
            self.db.register("tokens", pa.table({"doc": doc, "place": np.arange(len(token), dtype=np.int32), "token": token.view(np.int32)}))
            found = self.db.sql(DECODE).to_arrow_table()
            self.db.unregister("tokens")
            for i, text in zip(found.column("doc").to_pylist(), found.column("text").to_pylist()):
                out[owner[i]].append(text.encode("latin-1"))

        for row, raw in enumerate(ids):
            token = np.frombuffer(raw or b"", "<u4")
            for lo in range(0, len(token), ROWS):
                owner.append(row)
                held.append(token[lo:lo + ROWS])
                rows += len(held[-1])
                if rows >= ROWS:
                    flush()
                    owner, held, rows = [], [], 0
        if held:
            flush()
        return [b"".join(x) for x in out]


def _gathered(texts: pa.Array) -> Iterator[tuple[list[int], list[bytes]]]:
    """``(row of each piece, pieces)``, about ``PIECE`` bytes at a time; long texts are cut where a gap begins."""
    owner, pieces, held = [], [], 0
    for row, value in enumerate(texts):
        data = value.as_buffer().to_pybytes() if value.is_valid else b""
        lo = 0
        while lo < len(data):
            hi = len(data)
            if hi - lo > PIECE:
                ahead = _CUT.search(data, lo + PIECE)
                hi = ahead.start() + 1 if ahead else hi
            owner.append(row)
            pieces.append(data[lo:hi])
            held += hi - lo
            lo = hi
            if held >= PIECE:
                yield owner, pieces
                owner, pieces, held = [], [], 0
    if pieces:
        yield owner, pieces


#: a plain character, then a blank: what follows the character is matched for itself
_CUT = re.compile(rb"[\x21-\x7e][\x20\x09-\x0d]")


def _units(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, stop, piece)`` of the units: each piece is cut before every blank that follows a plain
    character (no match goes on from one into the other); a piece with rare white space is not cut."""
    n = len(raw)
    cut = np.zeros(n + 1, bool)
    blank, plain = SPACE[raw], (raw > 0x20) & (raw < 0x7F)
    cut[1:n] = blank[1:] & ~blank[:-1]
    # behind other characters only where the whole piece has no white space but the six plain ones
    firm = cut.copy()
    firm[1:n] &= plain[:-1]
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        part = raw[a:b]
        if (part >= 0x80).any() and _RARE_SPACE.search(part.tobytes().decode()):
            cut[a:b] = firm[a:b]
    cut[begins] = True
    at = np.flatnonzero(cut)
    start, stop = at[:-1], at[1:]
    return start, stop, np.searchsorted(begins, start, "right") - 1


_KNOWN: dict[tuple[str, str], Vocabulary] = {}


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One per Python worker, file and pattern."""
    if (path, pattern) not in _KNOWN:
        _KNOWN[path, pattern] = Vocabulary(path, pattern)
    return _KNOWN[path, pattern]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``PIECE`` bytes, or one row."""
    sizes = [len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(column)]
    lo = 0
    while lo < batch.num_rows:
        hi, size = lo + 1, sizes[lo]
        while hi < batch.num_rows and size + sizes[hi] <= PIECE:
            size, hi = size + sizes[hi], hi + 1
        yield batch.slice(lo, hi - lo)
        lo = hi


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids`` of every row; ``ids`` are the tokens as little-endian unsigned 32-bit integers.

    Special tokens' strings are ordinary text.  Null and empty texts have no tokens.  A text may be of any
    length: it is cut into pieces of 1 MB where no match goes on; a single word may be long too, it takes as many
    steps as it has different pairs to contract.  Repeated rows stay, null ids come back as they are, an empty
    table gives no rows, and other columns are not read.  ``path`` must be readable by every executor.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path, pattern)
        for batch in batches:
            for part in _slices(batch, 1):
                ids = known.encode(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) >> 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                                                 ["id", "n_tokens", "ids"])
                give_back()  # beside this worker lie the decoder's and those of the other cores

    return rows.mapInArrow(run, "id bigint, n_tokens bigint, ids binary")


def decode_ids(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``id, n_tokens, ids, bytes`` of rows as ``encode_texts`` gives them: the bytes that their ids stand for.

    No ids (null or empty) are no bytes.  Ids that the vocabulary lacks stand for nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path, pattern)
        for batch in batches:
            for part in _slices(batch, 2):
                found = known.decode([x.as_buffer().to_pybytes() if x.is_valid else b"" for x in part.column(2)])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], ["id", "n_tokens", "ids", "bytes"])
                give_back()

    return tokens.select("id", "n_tokens", "ids").mapInArrow(run, "id bigint, n_tokens bigint, ids binary, bytes binary")

"""Merkle manifest (11), byte-level BPE (12) and hard negatives (13) against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cordon.llm import bytebpe, merkle, negatives
from cordon.llm.idcache import KnownIds, Recent

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def fields(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def climb(tree, i):
    """Siblings of leaf ``i`` from its run up, and a function that folds another leaf."""
    runs = []
    for level in tree[:-1]:
        first = i - i % 3
        runs.append((level[first:i], level[i + 1:first + 3]))
        i //= 3
    return runs


def brute_manifest(rows):
    """``{(doc_id, leaf): sorted list of (subroot, root, proof, folded)}`` with text newlines deleted for even crc32."""
    leaf = {id(r): fields(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in rows}
    per = {}
    for r in rows:
        per.setdefault(r.source, []).append(r)
    names = sorted(per, key=lambda s: (s is not None, (s or "").encode()))
    trees, out = {}, []
    for s in names:
        per[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf[id(r)]))
        trees[s] = levels([leaf[id(r)] for r in per[s]])
    top = levels([trees[s][-1][0] for s in names])
    for k, s in enumerate(names):
        for i, r in enumerate(per[s]):
            runs = climb(trees[s], i) + climb(top, k)
            text = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            fold = fields(r.doc_id, r.source, r.lang, r.n_chars, text)
            for left, right in runs:
                fold = h(*left, fold, *right)
            proof = h(*[x for left, right in runs for x in left + right])
            out.append((r.doc_id, leaf[id(r)], trees[s][-1][0], top[-1][0], proof, fold, fold == top[-1][0]))
    return sorted(out, key=str)


def digest_rows(docs):
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = merkle.leaf_hash(*[F.translate("text", "\n", "") if c == "text" else F.col(c) for c in merkle.FIELDS])
    leaf = merkle.leaf_hash(*[F.col(c) for c in merkle.FIELDS])
    found = merkle.manifest(docs, other_leaf=F.when(chosen, tampered).otherwise(leaf))
    rows = found.select("id", "leaf", "subroot", "root", merkle.proof_hash(F.col("proof")), merkle.folded(F.col("other"), F.col("proof")).alias("f")) \
        .withColumn("ok", F.col("f") == F.col("root")).collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 80, 81, 100, 242, 243, 244])
def test_positions_are_the_order_of_completion(n):
    """An append log simulated node by node gives each node the place of the closed form."""
    log, runs, top = [], {}, merkle.height(n)

    def put(level, index):
        log.append((level, index))
        if level < top:
            run = runs.setdefault(level, [])
            run.append(index)
            if len(run) == 3:
                runs[level] = []
                put(level + 1, index // 3)

    for i in range(n):
        put(0, i)
    for level in range(top):
        if runs.get(level):
            index = runs[level][-1] // 3
            runs[level] = []
            put(level + 1, index)
    assert [merkle.position(n, *node) for node in log] == list(range(len(log)))


def test_manifest_matches_brute_force(spark, docs, monkeypatch):
    wide = docs.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("\nline\n"))).otherwise(F.col("text")))
    wide = wide.unionByName(wide.filter("doc_id < 20")) \
        .unionByName(wide.limit(4).withColumn("doc_id", F.lit(None).cast("long"))) \
        .unionByName(wide.limit(2).withColumn("source", F.lit("")).withColumn("lang", F.lit(None).cast("string")))
    expected = brute_manifest(wide.collect())
    assert digest_rows(wide) == expected
    monkeypatch.setattr(merkle, "SPAN", 1)  # many tiers
    assert digest_rows(wide.repartition(5)) == expected


def test_manifest_of_one_big_source_and_many_small(spark):
    rows = spark.range(1500).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1000, "big").otherwise(F.concat(F.lit("h"), F.col("id"))).alias("source"),
                                    F.lit("en").alias("lang"), F.lit(3).cast("long").alias("n_chars"), F.concat(F.lit("t\n"), F.col("id") % 7).alias("text"))
    assert digest_rows(rows) == brute_manifest(rows.collect())


def test_log_is_in_completion_order(spark):
    leaves = spark.range(1000).select(F.lit("s").alias("tree"), F.lit(1000).cast("long").alias("n"), F.col("id").alias("idx"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("hash"))
    log, _ = merkle.append_log(leaves, 1000)
    rows = log.orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(len(rows)))
    tree = levels([hashlib.sha256(str(i).encode()).hexdigest() for i in range(1000)])
    assert {(r.level, r.idx): r.hash for r in rows} == {(lv, i): x for lv, row in enumerate(tree) for i, x in enumerate(row)}
    assert (rows[-1].level, rows[-1].hash) == (merkle.height(1000), tree[-1][0])


def test_manifest_edges(spark, docs, empty_docs, clashing):
    assert merkle.manifest(empty_docs).collect() == []
    one = docs.limit(1)
    row = merkle.manifest(one).first()
    assert row.subroot == row.root == row.leaf and [list(p) for p in row.proof] == []
    key = lambda r: str((r.id, r.leaf, r.proof, r.root))
    assert sorted(map(key, merkle.manifest(clashing.withColumn("tree", F.lit("x")).withColumn("hash", F.lit(1)).withColumn("idx", F.lit(2))).collect())) \
        == sorted(map(key, merkle.manifest(docs).collect()))
    long = spark.createDataFrame([(1, "x\n" * 2_000_000, "en", "s", 5)], docs.schema)
    assert merkle.manifest(long).first().leaf == fields(1, "s", "en", 5, "x\n" * 2_000_000)


@pytest.fixture(scope="module")
def reference_encoding():
    import base64

    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoding, text):
    return np.array(encoding.encode_ordinary(text or ""), "<u4").tobytes()


def odd_texts():
    rng = random.Random(3)
    alphabet = list("abcdeABC  \n\t\r'!.,=-0129") + ["é", "ß", "あ", "漢", "字", " ", "　", " ", "\x85", "\x1c", "\x1f", "🙂", "é"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 80))) for _ in range(1500)]
    texts += ["a" * k for k in range(1, 40)] + ["=" * 1000, " " * 501, "\n" * 300 + "a", "ab" * 700, "<|endoftext|> I'll don't 'S", " a   b", "x  ", "x \n y"]
    return texts + ["".join(rng.choice("abcdefgh") for _ in range(1500)), None, ""]


def test_encoding_equals_the_library(reference_encoding):
    known, texts = bytebpe.Vocabulary(RANKS, PATTERN), odd_texts()
    got = known.encode(pa.array(texts, pa.string()))
    assert [t for t, g in zip(texts, got) if g != ids_of(reference_encoding, t)] == []
    assert [x.decode() for x in known.decode(got)] == [t or "" for t in texts]


def test_long_and_short_words_contract_alike():
    known = bytebpe.Vocabulary(RANKS, PATTERN)
    rng = random.Random(8)
    words = ["".join(rng.choice("abctheinr") for _ in range(rng.randrange(2, 60))).encode() for _ in range(800)] + [b"a" * k for k in range(1, 60)]
    longer = b"z" * 70  # makes the query for words of any length run
    assert known.contract(words) == known.contract([*words, longer])[:-1]


def test_texts_are_cut_between_matches(reference_encoding, monkeypatch):
    monkeypatch.setattr(bytebpe, "PIECE", 50)
    monkeypatch.setattr(bytebpe, "ROWS", 7)
    monkeypatch.setattr(bytebpe, "KEPT", 8)
    known = bytebpe.Vocabulary(RANKS, PATTERN)
    known.units = KnownIds(20)
    texts = odd_texts()[:300] + [" ".join(t for t in odd_texts()[:200] if t)]
    got = known.encode(pa.array(texts, pa.string()))
    assert got == [ids_of(reference_encoding, t) for t in texts]
    assert [x.decode() for x in known.decode(got)] == [t or "" for t in texts]


def test_words_beyond_the_cache_and_small_queries(reference_encoding, monkeypatch):
    """A unit may hold more words than the cache keeps, and a query gets few bytes of words, or one word."""
    monkeypatch.setattr(bytebpe, "KEPT", 4)
    monkeypatch.setattr(bytebpe, "CONTRACTED", 40)
    known = bytebpe.Vocabulary(RANKS, PATTERN)
    real, sizes = known.contract, []
    monkeypatch.setattr(known, "contract", lambda words: sizes.append((len(words), sum(map(len, words)))) or real(words))
    texts = [",".join(f"qz{i}xv" for i in range(60)), "q" * 90 + "z"]
    assert known.encode(pa.array(texts)) == [ids_of(reference_encoding, t) for t in texts]
    assert sizes and all(n == 1 or size <= 40 for n, size in sizes)


def test_workers_give_memory_back(spark, monkeypatch):
    """Both operators return freed memory while they run, after each part of a batch."""
    monkeypatch.setattr(bytebpe, "PIECE", 2000)
    taken = []
    monkeypatch.setattr(bytebpe, "give_back", lambda: taken.append(1))
    runs = []

    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            runs.append(run)
            return self

    bytebpe.decode_ids(bytebpe.encode_texts(Rows(), RANKS, PATTERN), RANKS, PATTERN)
    texts = ["some words " * 100] * 5
    rows = [pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(texts)], ["id", "text"])]
    encoded = list(runs[0](iter(rows)))
    assert len(taken) == len(encoded) > 1
    assert [x.decode() for b in runs[1](iter(encoded)) for x in b.column(3).to_pylist()] == texts and len(taken) > len(encoded)


def test_two_strings_of_one_hash(reference_encoding, monkeypatch):
    """Where the first hash says two units are one, the second one tells, and each is encoded for itself."""
    real = bytebpe.span_hash
    monkeypatch.setattr(bytebpe, "span_hash", lambda p, a, b, which=0: real(p, a, b, which) if which else (b - a).astype(np.uint64))
    known = bytebpe.Vocabulary(RANKS, PATTERN)
    texts = ["some words of different sizes and the same", "rows rows cows"]
    assert known.encode(pa.array(texts)) == [ids_of(reference_encoding, t) for t in texts]


def test_bpe_query_rows(spark, docs, empty_docs, clashing, reference_encoding):
    both = bytebpe.decode_ids(bytebpe.encode_texts(clashing.withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit("x")), RANKS, PATTERN), RANKS, PATTERN)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = both.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert bytes(r.ids) == ids_of(reference_encoding, texts[r.id]) and bytes(r.bytes).decode() == (texts[r.id] or "") and r.n_tokens * 4 == len(r.ids)
    assert bytebpe.encode_texts(empty_docs, RANKS, PATTERN).collect() == []


def test_known_ids_keep_and_forget():
    rng, cache = np.random.default_rng(1), KnownIds(50)
    value = lambda k: np.arange(int(k) % 4, dtype="<u4") + np.uint32(int(k) % 1000)
    calls = 0
    for _ in range(60):
        key = np.unique(rng.integers(0, 200, 30)).astype(np.uint64)

        def encode(new):
            nonlocal calls
            calls += len(new)
            return [value(key[i]).tobytes() for i in new]

        pool, begin, size = cache.ids_of(key, key * np.uint64(7), encode)
        assert all(np.array_equal(pool[b:b + s], value(k)) for k, b, s in zip(key, begin, size))
        assert len(cache.young.key) <= 50 + 30
    assert calls < 60 * 28
    few = Recent(2)
    for i in range(10):
        few.put(i, b"%d" % i)
    assert few.get(9) == b"9" and few.get(0) is None


def brute_negatives(rows):
    rows = [(i, lab, [int(np.floor(float(x) * 256)) for x in v]) for i, lab, v in rows
            if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    rows = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, v) for i, lab, v in rows]
    out = []
    for a, (i, lab, v) in enumerate(rows):
        if i % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other == lab) for b, (j, other, w) in enumerate(rows) if b != a)
        for s, j, _ in [x for x in scored if x[2]][:5]:
            found = [(t, k) for t, k, same in scored if not same and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(found)]
    return sorted(out)


def mined(frame):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.mine(frame.filter(negatives.usable(F.col("embedding"))), "vec_id", label, negatives.quantised(F.col("embedding")), F.col("vec_id") % 100 == 0)
    return sorted(tuple(r) for r in rows.collect())


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("cells,first,block", [(512, 16, 2048), (12, 2, 8)])
def test_negatives_match_brute_force(spark, monkeypatch, cells, first, block):
    for name, value in (("CELL_ROWS", cells), ("FIRST_CELLS", first), ("BLOCK_ROWS", block), ("VISITS", 4)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 9))
    rows = [(int(i) * 20, [float(np.float32(x)) for x in centres[i % 6] + rng.normal(size=9) * 0.4], int(rng.integers(0, 4))) for i in range(400)]
    rows += [(100 * i, rows[3][1], 2) for i in range(30)]                  # a crowd of one vector, ids that repeat
    rows += [(9001, None, 1), (9002, [1.0, None], 1), (9003, [float("nan")] * 9, 1), (9100, rows[0][1], None), (None, rows[0][1], 1),
             (9200, [float("inf")] * 9, 1), (9300, [], 3), (9400, [1.0, 2.0], 3), (9500, [0.0] * 9, 1)]
    assert mined(spark.createDataFrame(rows, VECTORS)) == brute_negatives(rows)


def test_negatives_edges(spark):
    assert mined(spark.createDataFrame([], VECTORS)) == []
    assert mined(spark.createDataFrame([(100, [1.0, 2.0], 1)], VECTORS)) == []
    few = [(100, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [0.95, 0.0], 2)]
    assert mined(spark.createDataFrame(few, VECTORS)) == brute_negatives(few) == [(100, 1, 1, 2, 65536, 32768)]
    clash = spark.createDataFrame(few, VECTORS).selectExpr("*", "1 AS id", "2 AS vec", "3 AS uid", "4 AS cell", "5 AS anchor")
    assert mined(clash) == brute_negatives(few)
    wide = [(100, [3.0e8, 1.0], 1), (1, [1.0, 1.0], 1)]
    with pytest.raises(ValueError, match="2\\^56"):
        mined(spark.createDataFrame(wide, VECTORS))
    long = [(i, [0.01 * ((i * j) % 7) for j in range(3000)], i % 2) for i in range(90, 130)]
    assert mined(spark.createDataFrame(long, VECTORS)) == brute_negatives([(i, np.float32(v).tolist(), lab) for i, v, lab in long])


def test_heap_visits_cells_by_descending_bound():
    rng = np.random.default_rng(2)
    index = negatives.MultiIndex(rng.normal(size=(5, 3)), rng.normal(size=(4, 2)))
    index.radii = rng.random(5), rng.random(4)
    index.cells = frozenset(int(c) for c in rng.choice(20, 13, replace=False))
    q = rng.normal(size=5)
    got = list(index.visits(q))
    one, two = index.bounds(q)
    assert sorted(c for _, c in got) == sorted(index.cells)
    assert [b for b, _ in got] == sorted((one[c // 4] + two[c % 4] for c in index.cells), reverse=True)


def test_no_cross_join_in_the_plans(spark):
    from cordon.llm.queries import llm_queries

    for name in ("op11_postorder_manifest", "op12_recursive_bpe", "op13_multi_index_negatives"):
        df = llm_queries()[name](spark, "/root/testdata/sf0.001")
        text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_registered_rows(spark, reference_encoding):
    """The registered queries on the smallest tables, against the library and plain Python."""
    from cordon.llm.queries import llm_queries

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in llm_queries()["op12_recursive_bpe"](spark, sf).collect():
        ids = ids_of(reference_encoding, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), h(texts[r.doc_id] or ""))
    rows = [(r.vec_id, r.label, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in llm_queries()["op13_multi_index_negatives"](spark, sf).collect()) == brute_negatives(rows)

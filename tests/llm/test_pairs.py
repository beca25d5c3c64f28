"""Repeated bytes (1) and the Jaccard join (4) against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from cordon.llm import jaccard, losertree, suffixdedup

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def kept_bytes(texts, length):
    """(n_bytes, n_removed, n_spans, sha256) of each text, in order."""
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = True
            seen.add(w)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        edges = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        out.append((len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def components_of(texts, ids):
    sets = {}
    for i, t in zip(ids, texts):
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(ids)
    for n, a in enumerate(order):
        for b in order[:n]:
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if either and 100 * both >= 80 * either:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("many,part", [(2000, 40_000), (1, 40_000), (2000, 5)])
def test_repeats_match_brute_force(docs, prose, many, part):
    """Sorted together, all by hashes (``many=1``), and over many parts."""
    got = suffixdedup.remove_repeats(docs, many=many, part=part).orderBy("id").collect()
    assert [tuple(r)[1:] for r in got] == kept_bytes(prose, 100)


def test_repeats_of_other_lengths_and_outputs(docs, prose):
    got = suffixdedup.remove_repeats(docs, length=40, gram=16, with_kept=True).orderBy("id").collect()
    assert [tuple(r)[1:5] for r in got] == kept_bytes(prose, 40)
    for r in got:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed


def test_repeats_with_shared_and_null_ids(spark, empty_docs, clashing, prose):
    long = "q r s t u v " * 20 + "end"
    rows = spark.createDataFrame([(None, long), (5, long), (5, long), (5, "other " * 30), (7, None)], "doc_id long, text string")
    got = sorted((r.id if r.id is not None else -1, r.n_bytes, r.n_removed) for r in suffixdedup.remove_repeats(rows).collect())
    b = len(long)
    first = kept_bytes([long], 100)[0][1]
    # null comes first; the two equal rows of id 5 are one document, all of it repeated
    assert [x for x in got if x[1] == b] == [(-1, b, first), (5, b, b), (5, b, b)]
    assert suffixdedup.remove_repeats(empty_docs).collect() == []
    same = suffixdedup.remove_repeats(clashing).orderBy("id").collect()
    assert [tuple(r)[1:] for r in same] == kept_bytes(prose, 100)


def test_loser_tree_merges_like_sorting():
    rng = random.Random(2)
    for k in (1, 2, 3, 7):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 9))) for _ in range(rng.randrange(0, 40))) for _ in range(k)]
        coded = [losertree.front_code(r) for r in runs]
        merged = list(losertree.merge([losertree.decode_run(*c) for c in coded]))
        strings = [s for _, _, s in merged]
        assert strings == sorted(s for r in runs for s in r)
        assert [p for _, p, _ in merged][1:] == [losertree.common_prefix(a, b) for a, b in zip(strings, strings[1:])]


def test_join_matches_brute_force(docs, prose):
    ids = [r.doc_id for r in docs.select("doc_id").orderBy("doc_id").collect()]
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(docs).collect()}
    assert got == components_of(prose, ids)


def chains(rng, n, length):
    """Texts in which each is close to the next, so components are long chains; and one big crowd."""
    w = [f"c{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for i in range(n):
        out.append(" ".join(w))
        w = w[:]
        w[(i * 5) % length] = f"n{i}"
    return out


def test_join_on_chains_and_crowds(spark):
    """Many rounds: chains within one region, a crowd around the threshold, and sizes at the limit."""
    rng = random.Random(11)
    texts = chains(rng, 40, 60)
    base = [f"b{i}" for i in range(45)]
    for i in range(40):  # two to three edits in random places: pairs on both sides of the threshold
        w = base[:]
        for _ in range(rng.randrange(1, 3)):
            w[rng.randrange(45)] = f"z{i}"
        texts.append(" ".join(w))
    full = [f"f{i}" for i in range(104)]
    texts += [" ".join(full), " ".join(full[:84]), " ".join(full[:83]), " ".join(full[:68])]  # 100 against 80 and 79 shingles
    rng.shuffle(texts)
    ids = list(range(len(texts)))
    frame = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(5)
    got = {r.id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(frame).collect()}
    assert got == components_of(texts, ids)


def test_join_of_nulls_ties_and_nothing(spark, empty_docs, clashing, docs):
    rows = spark.createDataFrame([(None, "a b c d e f"), (4, "A b c d e f"), (4, "A b c d e f"), (2, None), (3, ""), (1, "lonely words")],
                                 "doc_id long, text string")
    got = sorted(((r.id or 0), r.n_shingles, r.component_id) for r in jaccard.similar_components(rows).collect())
    assert got == [(0, 2, 4), (1, 1, 1), (2, 0, 2), (3, 0, 3), (4, 2, 4), (4, 2, 4)]
    assert jaccard.similar_components(empty_docs).collect() == []
    one = jaccard.one_per_group(rows)
    assert one.columns == ["doc_id", "text"]
    assert sorted((r.doc_id, r.text) for r in one.collect()) == [(1, "lonely words"), (2, None), (3, ""), (4, "A b c d e f")]
    kept = jaccard.one_per_group(clashing)
    assert kept.columns == clashing.columns
    firsts = {r.component_id for r in jaccard.similar_components(docs).collect()}
    assert {r.doc_id for r in kept.collect()} == firsts


def test_window_covers_every_linked_pair():
    """Two sets within the radius share one of the first pivots of both, whatever the order."""
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(1, 60)
        a = rng.sample(range(200), n)
        b = [x for x in a if rng.random() > 0.1] + rng.sample(range(200, 300), rng.randrange(0, 8))
        both, either = len(set(a) & set(b)), len(set(a) | set(b))
        if b and 100 * both >= 80 * either:
            rank = lambda s: sorted(s, key=lambda x: (x * 7919) % 1009)[:jaccard.window(len(s))]
            assert set(rank(a)) & set(rank(b))


def test_place_bound_keeps_every_linked_pair():
    """In the first pivot that two linked sets share, the bound by places holds; it rules out some that are not linked."""
    rng = random.Random(4)
    ruled_out = 0
    for _ in range(600):
        n = rng.randrange(1, 80)
        a = rng.sample(range(200), n)
        b = [x for x in a if rng.random() > rng.choice((0.02, 0.1, 0.3))] + rng.sample(range(200, 300), rng.randrange(0, 12))
        both, either = len(set(a) & set(b)), len(set(a) | set(b))
        order = lambda s: sorted(s, key=lambda x: (x * 7919) % 1009)
        x, y = order(a), order(b)
        common = [v for v in x[:jaccard.window(len(x))] if y and v in y[:jaccard.window(len(y))]]
        if not common:
            continue
        held = min(len(x) - x.index(common[0]), len(y) - y.index(common[0])) * 9 >= (len(x) + len(y)) * 4
        linked = 100 * both >= 80 * either
        assert held or not linked
        ruled_out += not held
    assert ruled_out

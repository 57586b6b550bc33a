import random
import re

import pytest

from tests.llm.conftest import words
from tidemark.llm.jaccard import jaccard_components, needed, one_of_each, prefix_length

W = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def brute(docs, n=3, percent=90):
    sets = []
    for doc, text in docs:
        w = W.findall(lowered(text))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    parent = list(range(len(docs)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for a in range(len(docs)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                parent[find(a)] = find(b)
    out = []
    for k, (doc, _) in enumerate(docs):
        group = [d for j, (d, _) in enumerate(docs) if find(j) == find(k) and d is not None]
        out.append((doc, len(sets[k]), min(group) if group else None))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def variants(seed, n_docs=90, length=110):
    """Copies of a few texts with words exchanged, so that similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    bases = [words(length + 7 * k, 100 * seed + k) for k in range(3)]
    docs = []
    for k in range(n_docs):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 2, 3, 4, 6])):
            at = rng.randrange(len(w))
            w[at:at + rng.choice([0, 1, 1, 2])] = [f"new{rng.randrange(40)}"]
        docs.append((k * 3 + 1, " ".join(w)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(make, seed):
    docs = variants(seed)
    assert order(map(tuple, jaccard_components(make(docs)).collect())) == order(brute(docs))


def test_other_sizes_and_thresholds(make):
    docs = variants(5, 60, 40)
    got = jaccard_components(make(docs), n_gram=5, percent=80, orders=3)
    assert order(map(tuple, got.collect())) == order(brute(docs, 5, 80))


def test_odd_documents(odd, clashing):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    for frame in (odd, clashing(odd)):
        assert order(map(tuple, jaccard_components(frame).collect())) == order(brute(docs))


def test_short_sets_link_from_nine_to_ten(make):
    w = words(12, 7, 5000)
    docs = [(1, " ".join(w)), (2, " ".join(w[:11])), (3, " ".join(w[:10])), (4, " ".join(w[:2])), (5, " ".join(w[:2]).upper())]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(make(docs)).collect()}
    assert got == {1: (10, 1), 2: (9, 1), 3: (8, 3), 4: (1, 4), 5: (1, 4)}


def test_empty_table(make):
    assert jaccard_components(make([])).collect() == []
    assert one_of_each(make([])).collect() == []


def test_one_of_each_keeps_columns_and_the_smallest_id(make):
    docs = variants(3, 40)
    frame = make(docs)
    kept = one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute(docs)})


def test_bounds():
    for percent in (80, 90):
        for n in range(1, 200):
            assert prefix_length(n, percent) == n - -(-percent * n // 100) + 1
            least = needed(2 * n, percent)
            assert 100 * least >= percent * (2 * n - least) and not 100 * (least - 1) >= percent * (2 * n - least + 1)


def test_an_id_with_a_copy_and_a_text_of_its_own(make):
    a, b = " ".join(words(120, 21)), words(120, 22)
    near = " ".join(b[:60] + ["exchanged"] + b[61:])
    docs = [(1, a), (2, a), (2, " ".join(b)), (9, near)]
    assert order(map(tuple, jaccard_components(make(docs)).collect())) == order(brute(docs))
    assert sorted((r.doc_id, r.text) for r in one_of_each(make(docs)).collect()) == sorted(docs[:3])


def test_ids_with_many_texts(make):
    docs = [(k % 13 if k % 13 else None, text) for k, (_, text) in enumerate(variants(8, 60, 90))]
    docs += [(20 + k, text) for k, (_, text) in enumerate(docs[::7])]
    assert order(map(tuple, jaccard_components(make(docs)).collect())) == order(brute(docs))

from collections import defaultdict

import pytest

from ledgerflow.llm import ngram_join
from tests.llm.corpus import LOWER, by_id, corpus, frame, words


def shingles(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3)))


def brute(rows, percent=85):
    """Component per row position, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    pairs = {(i, j) for held in holders.values() for i in held for j in held if i < j}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if rows[i][0] is not None and rows[j][0] is not None and both * 100 >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((find(i), find(j)), key=lambda k: rows[k][0])
            root[b] = a
    return [(rows[i][0], len(sets[i]), rows[find(i)][0]) for i in range(len(rows))]


def check(spark, rows, percent=85):
    found = ngram_join.ngram_components(frame(spark, rows), percent=percent).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows, percent), key=key)


@pytest.mark.parametrize("percent", [85, 60])
def test_equals_brute_force(spark, percent):
    check(spark, corpus(seed=11, n=180), percent)


def test_chains_and_thresholds(spark):
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(25):                                   # a chain: each near the next, the ends far apart
        rows.append((100 - k, " ".join(base[:k] + [f"x{i}" for i in range(k)] + base[k:])))
    for cut in range(0, 14):                              # sizes on both sides of the threshold
        rows.append((200 + cut, " ".join(base[cut:])))
    rows += [(None, " ".join(base)), (None, None), (300, ""), (301, " \t\n"), (302, "a b"), (303, "A  B"), (304, "a b c")]
    check(spark, rows)


def test_hot_group_and_common_passage(spark):
    common = " ".join(f"c{i}" for i in range(40))
    rows = [(i, f"{common} " + " ".join(f"d{i}x{j}" for j in range(i % 30))) for i in range(150)]
    rows += [(1000 + i, rows[7][1]) for i in range(80)]
    check(spark, rows)


def test_words_of_mirrored_letters_are_told_apart(spark):
    one = "a"
    for _ in range(10):
        one += one.translate(str.maketrans("ab", "ba"))
    other = one.translate(str.maketrans("ab", "ba"))
    rows = by_id(ngram_join.ngram_components(frame(spark, [(1, one), (2, other), (3, other)])))
    assert [rows[i].component_id for i in (1, 2, 3)] == [1, 2, 2]


def test_repeated_ids_extra_columns_and_empty_table(spark):
    docs = frame(spark, [(5, "one two three four five"), (5, "six seven eight nine"), (4, "one two three four five")])
    docs = docs.selectExpr("*", "doc_id AS rep", "text AS digest", "text AS head")
    found = sorted(map(tuple, ngram_join.ngram_components(docs).collect()))
    assert found == [(4, 2, 4), (5, 1, 5), (5, 2, 4)]
    assert ngram_join.ngram_components(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        ngram_join.ngram_components(docs, percent=20)


def test_very_long_text(spark):
    long = " ".join(f"v{i}" for i in range(400_000))
    check_rows = [(1, long), (2, long + " tail"), (3, "x" * 3_000_000), (4, " ".join(["same"] * 300_000))]
    rows = by_id(ngram_join.ngram_components(frame(spark, check_rows)))
    assert [(rows[i].n_shingles, rows[i].component_id) for i in (1, 2, 3, 4)] == [
        (399_997, 1), (399_998, 1), (1, 3), (1, 4)]

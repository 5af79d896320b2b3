import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from chorale.llm import near_duplicates as nd
from chorale.llm.components import components
from chorale.llm.words import PLAIN, words_of
from tests.llm import odd


def bag(text):
    words = odd.plain(text)
    if 0 < len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def expected_classes(rows):
    """Classes by comparing all texts that share a run of words."""
    texts = sorted({t or "" for _, t in rows})
    bags = [bag(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, b in enumerate(bags):
        for run in b:
            holders[run].append(k)
    for i, j in {(i, j) for own in holders.values() for i in own for j in own if i < j}:
        if (bags[i] & bags[j]).total() >= 0.8 * (bags[i] | bags[j]).total():
            parent[root(i)] = root(j)
    group = {t: root(k) for k, t in enumerate(texts)}
    least = {}
    for doc_id, t in rows:
        key = (doc_id is None, doc_id or 0)
        g = group[t or ""]
        least[g] = min(least.get(g, key), key)
    return [(i, None if least[group[t or ""]][0] else least[group[t or ""]][1]) for i, t in rows]


def edited(text, n, seed):
    words = text.split()
    rng = random.Random(seed)
    for k in rng.sample(range(len(words)), n):
        words[k] = f"edit{seed}x{k}"
    return " ".join(words)


def test_classes_equal_brute_force(spark, folder):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    base = " ".join(f"w{k}" for k in range(200))
    copies = [(9000 + s, edited(base, s % 4, s)) for s in range(60)] + [(9100, base + " tail")]
    rows = given + copies + [(r[0], r[1]) for r in odd.rows() if len(r[1] or "") < 10_000]
    docs = odd.clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    found = nd.classes(nd.with_node(docs.drop("node"))).collect()
    # The same id with other texts makes classes of their own under one name; count rows.
    odd.same_rows([(r.doc_id, r.class_id) for r in found], expected_classes(rows))
    one = nd.deduplicated(docs)
    assert one.schema == docs.schema
    texts = {g for g in zip(*[[r.class_id for r in found], [r.node for r in found]], strict=True)}
    assert one.count() == len({(r.doc_id, bytes(r.node)) for r in found if r.kept}) <= len(texts)


def test_a_loose_group_is_joined_where_links_are(spark):
    """Edits of edits: neighbours are alike, the ends are not; no text is close to all."""
    text = " ".join(f"w{k}" for k in range(300))
    chain = [text]
    for s in range(12):
        chain.append(edited(chain[-1], 3, s))
    rows = list(enumerate(chain)) + [(100, " ".join(f"v{k}" for k in range(300)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = nd.classes(nd.with_node(docs)).collect()
    odd.same_rows([(r.doc_id, r.class_id) for r in found], expected_classes(rows))
    assert {r.class_id for r in found} == {0, 100}


def test_agreement_estimates_weighted_similarity():
    base = " ".join(f"w{k}" for k in range(400))
    texts = [base] + [edited(base, n, n) for n in (2, 8, 20, 40)] + [base + " " + base, "too short", ""]
    values, held = nd.signatures(
        *nd.shingles(words_of(pa.array(texts), PLAIN, lower=True)), len(texts), 3000
    )
    assert held.tolist() == [True] * 7 + [False]
    exact = nd._similarities(pa.array([base] * len(texts)), pa.array(texts))
    agreed = (values[0] == values).mean(axis=1)
    assert np.abs(agreed[:7] - exact[:7]).max() < 0.04
    assert 0.45 < exact[5] < 0.55


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 201), (201, 202), (202, 200)]
    rng.shuffle(links)
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {(r.node, r.component) for r in found} == {
        (n, 0 if n < 100 else n // 100 * 100) for link in links for n in link
    }
    assert len(found) == len({r.node for r in found})
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_empty_table(spark):
    none = odd.table(spark).limit(0)
    assert nd.classes(nd.with_node(none)).collect() == []
    assert nd.deduplicated(none).collect() == []

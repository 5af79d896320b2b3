import math
import os
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from chorale.llm import kneser_ney as kn
from tests.llm import odd


def tokens(text):
    return [*odd.spaced((text or "").translate(odd.LOWER)), "</end>"]


class Plain:
    """The same model from dictionaries."""

    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for t in map(tokens, texts):
            self.words.update(t)
            self.pairs.update(zip([None, *t[:-1]], t, strict=True))
        self.before = Counter(w for _, w in self.pairs)
        self.follow = defaultdict(list)
        for (v, _), c in self.pairs.items():
            self.follow[v].append(c)
        self.n, self.size, self.types = self.words.total(), len(self.words), len(self.pairs)
        self.d = self.discounts(self.pairs.values())
        self.e = self.discounts(self.before.values())
        cut = sum(self.cut(c, self.e) for c in self.before.values())
        self.rest = cut / self.types if self.types else 1
        self.after = {v: sum(own) for v, own in self.follow.items()}
        self.gamma = {
            v: sum(self.cut(c, self.d) for c in own) / self.after[v] for v, own in self.follow.items()
        }

    @staticmethod
    def discounts(values):
        n = Counter(values)
        return kn.discounts(*(n[k] for k in (1, 2, 3, 4)))

    @staticmethod
    def cut(count, d):
        return d[min(count, 3) - 1] if count else 0

    def p(self, v, w):
        low = max(self.before[w] - self.cut(self.before[w], self.e), 0) / max(self.types, 1)
        low += self.rest / (self.size + 1)
        if v not in self.after:
            return low
        count = self.pairs[v, w]
        return max(count - self.cut(count, self.d), 0) / self.after[v] + self.gamma[v] * low


def close(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("shard_bytes", [20_000, 16 << 20])
def test_scores_equal_plain_ones(spark, folder, monkeypatch, shard_bytes):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").limit(60).collect()]
    rows = given + [(1000, None), (1001, ""), (1002, "never seen words"), (1005, "again and " * 300), (1006, "again and " * 280), (1003, given[0][1]), (1003, given[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(kn, "WORDS_PER_SHARD", 500)
    fit = kn.fit
    monkeypatch.setattr(kn, "fit", lambda d: fit(d, shard_bytes))
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    plain = Plain([t for i, t in rows if not held[i]])
    texts = dict(rows)
    found = kn.report(odd.clashing(docs)).collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)
    for r in found:
        t = tokens(texts[r.doc_id])
        base = sum(math.log10((plain.words[w] + 0.5) / (plain.n + 0.5 * (plain.size + 1))) for w in t)
        score = sum(math.log10(plain.p(v, w)) for v, w in zip([None, *t[:-1]], t, strict=True))
        known = sum(w in plain.words for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), known, plain.n)
        assert close(r.base_score, base) and close(r.score, score)


def test_probabilities_add_up_and_beat_the_base(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    plain = Plain([r.text for r in docs.limit(40).collect()])
    for v in (None, "the", "never seen"):
        assert close(sum(plain.p(v, w) for w in plain.words) + plain.p(v, "never seen"), 1)
    held = [r for r in kn.report(docs).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_nothing_to_learn_from(spark):
    docs = odd.table(spark)
    assert kn.report(docs.limit(0)).collect() == []
    model = kn.fit(docs.limit(0))
    assert {r.score for r in kn.scored(docs, model).collect()} == {0.0}


def test_missing_or_cut_files_are_an_error(spark, folder, monkeypatch):
    monkeypatch.setattr(kn, "WORDS_PER_SHARD", 500)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").limit(40)
    model = kn.fit(docs, 50_000)
    texts = pa.array([r.text for r in docs.collect()])
    scores = model.score(texts)[3]
    names = {n.split(".")[0] for n in os.listdir(model.folder)}
    # Each shard has files, whether anything is in it or not.
    assert {f"pairs-{k}" for k in range(model.pair_files)} | {f"words-{k}" for k in range(model.word_files)} == names
    for name in ("pairs-0.keys", "pairs-0.counts", "words-1.keys", f"words-1.{kn.WORD_COLUMNS[2]}"):
        path = os.path.join(model.folder, name)
        held = open(path, "rb").read()
        with open(path, "wb") as file:
            file.write(held[:-8])
        with pytest.raises(RuntimeError, match="length"):
            model.score(texts)
        os.rename(path, f"{path}-away")
        with pytest.raises(RuntimeError, match="missing"):
            model.score(texts)
        with open(path, "wb") as file:
            file.write(held)
    assert (model.score(texts)[3] == scores).all()


def test_flushes_write_no_rows_for_shards_without_pairs(spark):
    docs = spark.createDataFrame([(k, f"word{k} other{k}") for k in range(20)], "doc_id long, text string")
    rows = kn.count_pairs(docs.repartition(5), kn.np.array([int(kn.BEGIN)], kn.np.uint64), 1000).collect()
    full = [r for r in rows if r.words]
    assert len(rows) - len(full) == 1000 and len(full) <= 60


def test_odd_rows(spark):
    found = kn.report(odd.table(spark)).collect()
    assert len(found) == len(odd.rows())
    assert all(r.score <= 0 and r.n_tokens >= 1 for r in found)

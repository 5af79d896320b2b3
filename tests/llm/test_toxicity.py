import random
import zlib

import pyarrow as pa
import pytest

from chorale.llm import queries
from chorale.llm import toxicity as tx
from tests.llm import odd


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


ENTRIES = (
    ("idiot", False, 5.0),
    ("idiots", False, 4.0),
    ("scum", False, 3.0),
    ("worthless", False, 2.0),
    ("réeux", True, 2.0),
    ("moron", False, 6.0),
    ("morons", False, 5.5),
)


def best(word):
    """The nearest entry within its edits, by the distance to each; stems by their letters."""
    near = [
        (distance(word, e[0]), -e[2], k)
        for k, e in enumerate(ENTRIES)
        if not e[1] and distance(word, e[0]) <= tx.edits_of(e)
    ]
    stems = [(0, 0, k) for k, e in enumerate(ENTRIES) if e[1] and word.startswith(e[0])]
    exact = [x for x in near if x[0] == 0]
    edits, _, entry = min(exact or stems or near, default=(0, 0, -1))
    return entry, edits


def test_automaton_equals_distances_to_all_entries():
    draw = random.Random(3)
    words = {"", "idiot", "idi0t", "moron", "scum", "scam", "réeuxab", "reeux", "x" * 50, "morrons", "日本"}
    while len(words) < 3000:
        word = list(draw.choice(ENTRIES)[0])
        for _ in range(draw.randrange(4)):
            at = draw.randrange(len(word) + 1)
            word[at : at + draw.randrange(2)] = draw.choice([[], ["a"], ["é"], ["o", "s"]])
        words.add("".join(word) + draw.choice(["", "", "s", "xx"]))
    words = sorted(words)
    entry, edits = tx.LexiconAutomaton(ENTRIES).matches(pa.array(words, pa.large_string()))
    for word, e, d in zip(words, entry, edits, strict=True):
        assert (e, d) == best(word), word


@pytest.mark.parametrize(
    "left, right, kind",
    [
        ("such an ", " here", "plain"),
        ('He used "', '" once.', "quoted"),
        ("sie sagte „du bist ein ", "“, und ging", "quoted+reported+aimed"),
        ("il a écrit « un ", " ». Fin", "quoted+reported"),
        ("you are an ", "!", "aimed"),
        ('after a "break" came the ', " and no more", "plain"),
        ("'", "'", "quoted"),
    ],
)
def test_context(left, right, kind):
    assert tx.context(left, right)[0] == kind


FILLER = "the river ran along green fields while people went about their work in quiet towns".split()


def corpus():
    """Labelled rows and texts: insults, and clean texts that hold a word near one of them."""
    draw = random.Random(5)
    docs, labels = [], []
    for k in range(600):
        words = draw.choices(FILLER, k=30)
        toxic = k % 5 == 0
        if toxic:
            for word in draw.choices(["idiot", "moron", "worthless"], k=3):
                words.insert(draw.randrange(len(words)), word)
        elif k % 3 == 0:
            words.insert(4, "boron")
        elif k % 7 == 0:
            words = ["she", "said", '"the', "old", "word", 'idiot"', *words]
        docs.append((k, " ".join(words) + "."))
        labels.append((k, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = corpus()
    return tx.fit(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def scores(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.score for r in tx.scored(docs, model).orderBy("doc_id").collect()]


def test_lexicon_holds_the_terms_and_no_others(model):
    held = {t for t, _, _ in model.lexicon.entries}
    assert any("moron".startswith(t) for t in held) and any("worthless".startswith(t) for t in held)
    assert all(any(x.startswith(t) for x in ("idiot", "moron", "worthless")) for t in held)


def test_misspelt_terms_are_found_and_words_of_their_own_are_not(spark, model):
    base = " ".join(FILLER)
    texts = [base, f"{base} you mor0n, worthles and m*ron", f"{base} boron boron boron", "w0rthl3ss moron"]
    clean, misspelt, near, masked = scores(spark, model, texts)
    assert clean < 0.3 and misspelt > 0.5 and masked > 0.5
    assert near == pytest.approx(clean, abs=0.05)


def test_quotation_scores_lower_than_abuse(spark, model):
    base = " ".join(FILLER)
    abuse, quoted = scores(spark, model, [f"{base} you worthless moron. {base}", f'{base} He wrote the word "moron". {base}'])
    assert quoted < abuse


def test_hits_give_places(spark, model):
    text = "é you mor0n!"
    docs = spark.createDataFrame([(1, "clean"), (2, text), (3, None)], "doc_id long, text string")
    (hit,) = tx.hits(docs, model).collect()
    assert (hit.doc_id, hit.word, hit.edits, hit.context) == (2, "mor0n", 1, "aimed")
    assert text.encode()[hit.start : hit.end] == b"mor0n"


def test_slices_change_nothing(spark, model, monkeypatch):
    docs, _ = corpus()
    texts = pa.array([t for _, t in docs])
    whole = tx._features(texts, model.lexicon)
    parts = [tx._features(texts.slice(k, 7), model.lexicon) for k in range(0, len(texts), 7)]
    assert (whole == [row for part in parts for row in part]).all()


def test_odd_texts_and_labels(spark, model):
    docs = odd.clashing(odd.table(spark))
    found = tx.scored(docs, model).collect()
    assert len(found) == len(odd.rows())
    assert all(0 <= r.score <= 1 for r in found)
    assert tx.scored(docs.limit(0), model).collect() == []
    labels = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (6, None), (7, 0)], "doc_id long, toxic int")
    sample = tx.labelled(docs, labels).collect()
    assert sorted((r.doc_id, r.toxic) for r in sample) == [(5, 1), (7, 0)]
    for few in (labels.limit(0), labels.where("doc_id = 5")):
        plain = tx.fit(docs, few)
        assert len({r.score for r in tx.scored(docs, plain).collect()}) == 1


def test_sample_is_bounded(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text")
    labels = spark.range(4000).selectExpr("id AS doc_id", "1 AS toxic")
    n = tx.labelled(docs, labels, at_most=400).count()
    assert 300 < n < 500


def test_held_out_documents_are_told_apart(spark):
    folder = "/root/testdata/sf0.01"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.QUERIES["op13_toxicity"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in held if x for b, y in held if not y]
    assert sum(pairs) / len(pairs) > 0.85

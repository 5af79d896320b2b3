"""Quality rules and the license scan."""

import re
from collections import Counter

from chorale.llm import licenses, quality
from tests.llm import odd


def base(text):
    words = odd.spaced(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if odd.SPACED.search(line)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def test_base_counts_on_odd_and_given_texts(spark, folder):
    given = spark.read.parquet(f"{folder}/documents.parquet")
    for docs in (odd.clashing(odd.table(spark)), given):
        for r in quality.judged(docs).collect():
            found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
            assert found == base(r.text), r.doc_id


def test_lines_are_judged_one_by_one(spark):
    lines = [" ".join(f"w{n}x{k}" for k in range(12)) + end for n, end in enumerate([".", "!", '?"', "…)"])]
    bad = ["Home | About | Contact", "no end to this line", "### *** $$$ buy ###.", "We use cookies, see our Privacy Policy."]
    docs = spark.createDataFrame(
        [(1, "\n".join([*lines, *bad, ""])), (2, "\n".join([lines[0], *bad * 3])), (3, None)],
        "doc_id long, text string",
    )
    found = {r.doc_id: r for r in quality.judged(docs).collect()}
    assert found[1].clean_text == "\n".join([*lines, ""]) and found[1].kept
    assert found[1].n_failed_lines == 4 and found[1].n_lines == 8
    assert not found[2].kept and not found[3].kept and found[3].clean_text is None
    assert [r.text for r in quality.cleaned(docs).collect()] == [found[1].clean_text]


def test_long_lines_lose_only_what_failed(spark):
    prose = " ".join(" ".join(f"w{n}x{k}" for k in range(15)) + "." for n in range(40))
    wide = "".join("".join(f"w{n}x{k} " for k in range(15)) + "完。" for n in range(4))
    begun, ended = prose.split(". ", 1)[0] + ".", prose.split(". ", 1)[1]
    cases = {
        prose + " Tail": prose,
        prose + ' He said "so it is." and': prose + ' He said "so it is."',
        f"{begun} To go on: read more here. {ended}": f"{begun} {ended}",
        "See the Terms of Use today. " + prose: prose,
        prose + " Click here! And more": prose,
        prose: prose,
        wide + "tail": wide,
        f"Menu | Home\n{prose} end\nno end here": prose,
    }
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    assert {r.doc_id: r.text for r in quality.cleaned(docs).collect()} == dict(enumerate(cases.values()))
    for r in quality.judged(docs).collect():
        assert r.kept and r.kept_chars == sum(map(len, odd.spaced(r.clean_text)))
    bad = ["Tags: politics, sport and all", "Good day. Read more of this here.", "word " * 60, "a | b. " * 30]
    docs = spark.createDataFrame([(k, f"{t}\n{prose}") for k, t in enumerate(bad)], "doc_id long, text string")
    assert {r.text for r in quality.cleaned(docs).collect()} == {prose}


def test_cleaned_keeps_the_columns(spark):
    docs = odd.clashing(odd.table(spark))
    left = quality.cleaned(docs)
    assert left.schema == docs.schema
    rows = left.collect()
    assert rows and all(r.words == "own words" and r.n_chars == len(r.text) for r in rows)
    assert quality.cleaned(docs.limit(0)).collect() == []


def phrase_places(words):
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(parts)] == parts:
                yield i, label


def test_base_phrases(spark, folder):
    given = spark.read.parquet(f"{folder}/documents.parquet")
    for docs in (odd.clashing(odd.table(spark)), given):
        texts = Counter((r.doc_id, r.text) for r in docs.collect())
        expected = []
        for (doc_id, text), n in texts.items():
            words = odd.plain(text)
            places = sorted(phrase_places(words))
            labels = ",".join(sorted({label for _, label in places}))
            ends = (places[0][0], places[-1][0]) if places else (None, None)
            expected += [(doc_id, len(words), len(places), *ends, labels)] * n
        found = licenses.scanned(docs)
        odd.same_rows([r[:6] for r in found.collect()], expected)


def test_templates_at_the_threshold(spark):
    (long,) = licenses.TEMPLATES["mit-permission"]
    words = long.split()
    texts = {
        "mit-permission": [long, "Intro.\n" + long.replace("software", "thing") + "\nEnd.", " ".join(reversed(words))],
        "apache-2.0": ["x\nLicensed under the Apache Licence, Version 2.0\ny"],
        "": [" ".join(words[: len(words) // 2]), "released under the sun", None, ""],
    }
    rows = [(k, label, t) for k, (label, t) in enumerate((x, t) for x, ts in texts.items() for t in ts)]
    docs = spark.createDataFrame(rows, "doc_id long, label string, text string")
    found = {r.doc_id: r for r in licenses.scanned(docs).collect()}
    for doc_id, label, _ in rows:
        assert found[doc_id].labels == label
        assert (found[doc_id].score >= licenses.THRESHOLD) == bool(label)
    assert licenses.scanned(docs.limit(0)).collect() == []


def by_all_runs(text):
    """Every run of every paragraph against every template, without any filter."""
    found = {}
    for block in re.split(r"\n[\x20\x09-\x0D]*\n", text):
        words = odd.plain(block)
        for (label, _), tokens in licenses.template_words().items():
            for i in range(len(words)):
                run = words[i : i + licenses.RUN_RATIO * len(tokens)]
                share = len(set(run) & set(tokens)) / len(tokens)
                said = f" {' '.join(run)} "
                if share >= licenses.THRESHOLD and all(f" {m} " in said for m in licenses.MARKS[label]):
                    found[label] = max(found.get(label, 0), share)
    return found


def test_matches_equal_all_comparisons(spark, folder):
    notices = [t for ts in licenses.TEMPLATES.values() for t in ts]
    texts = [w for t in notices for w in (t, " ".join(t.split()[:-2]), t + " and more", f"x\n{t}\n\n{t[5:]}")]
    texts += [f"{a}\n{b}" for a in notices[::3] for b in notices[::4]] + [" ".join(reversed(t.split())) for t in notices]
    texts += [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if "icense" in r.text]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in licenses.matches(docs, ["doc_id"]).collect():
        found.setdefault(r.doc_id, {})[r.label] = max(r.containment, found.get(r.doc_id, {}).get(r.label, 0))
    expected = {k: by_all_runs(t) for k, t in enumerate(texts)}
    assert found == {k: v for k, v in expected.items() if v}


def test_what_names_another_license_or_none_does_not_match(spark):
    far = " ".join(f"x{k}" for k in range(2100))
    texts = {
        "Released under the BSD License": set(),
        "Licensed under CC BY 4.0": set(),
        "The tool was released under the Apache License": set(),
        "It is licensed under the GNU Lesser General Public License, version 3": {"lgpl-3.0"},
        "This work is licensed under the GNU General Public License, version 2": {"gpl-2.0"},
        f"It was released {far} a driving license under review by the court": set(),
        f"released {far} under the {far} MIT License": set(),
        "Licensed under the Apache License, Version 2.0\nand nothing else was released under the sun": {"apache-2.0"},
        f"{far} Released under\nthe MIT License. {far}": {"mit-license"},
    }
    assert labels_of(spark, texts) == list(texts.values())


def labels_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in licenses.matches(docs, ["doc_id"]).collect():
        found.setdefault(r.doc_id, set()).add(r.label)
    return [found.get(k, set()) for k in range(len(texts))]


def test_a_block_matches_all_its_templates(spark):
    every = " ".join(" ".join(t.split()) for ts in licenses.TEMPLATES.values() for t in ts)
    texts = {
        "Released under the MIT License. Licensed under the Apache License, Version 2.0": {"mit-license", "apache-2.0"},
        every: set(licenses.TEMPLATES),
        "Licensed under CC BY-NC 4.0": {"cc-by-nc"},
        "Licensed under CC BY-SA 4.0": {"cc-by-sa"},
        "Licensed under CC BY-NC-SA 4.0": {"cc-by-nc", "cc-by-sa"},
    }
    assert labels_of(spark, texts) == list(texts.values())


def test_wrapped_notices_match_in_long_paragraphs(spark):
    fill = [" ".join(f"x{n}y{k}" for k in range(9)) for n in range(30)]
    begin, end = "\n".join(fill[:15]), "\n".join(fill[15:])
    texts = {
        f"{begin} Released under\nthe MIT License. {end}": {"mit-license"},
        f"Released under\nthe MIT License. {end}": {"mit-license"},
        f"{begin} Licensed under CC\nBY-NC 4.0 {end} sa": {"cc-by-nc"},
        f"{begin} Licensed under CC BY-NC\n4.0 {end} Licensed under CC\nBY-SA 4.0": {"cc-by-nc", "cc-by-sa"},
        f"released {begin} under the {end} mit license": set(),
    }
    for label, (*_, notice) in licenses.TEMPLATES.items():
        words = notice.split()
        half = len(words) // 2
        texts[f"{begin} {' '.join(words[:half])}\n# {' '.join(words[half:])} {end}"] = {label}
    assert labels_of(spark, texts) == list(texts.values())

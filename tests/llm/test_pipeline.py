"""The stages one after another against plain Python."""

from collections import Counter

import corpus_pipeline
from chorale.llm import quality
from tests.llm import odd
from tests.llm.test_near_duplicates import edited, expected_classes
from tests.llm.test_packing import check_bins
from tests.llm.test_passages import windows


def sentence(n):
    return " ".join(f"word{n}x{k}" for k in range(12)) + "."


def text_of(n, lines=6):
    return "\n".join(sentence(f"{n}y{k}") for k in range(lines))


ITEM = " ".join(f"answer{k}" for k in range(14))


def rows():
    good = {n: text_of(n) for n in range(12)}
    good[20] = good[0]  # an exact copy
    good[21] = edited(good[1], 1, 3)  # a near copy
    good[22] = f"{text_of(22)}\n{odd.PASSAGE}."
    good[23] = f"{text_of(23)}\n{odd.PASSAGE}."
    good[24] = f"{odd.PASSAGE}."  # nothing but a passage
    good[25] = f"{text_of(25)}\nSee {ITEM} there."
    good[26] = text_of(26) + "\nHome | About | Contact"
    good[27] = "buy ### now *** cheap $$$ " * 10
    good[28] = None
    good[29] = text_of(29, 400)
    out = [(n, t, "en", f"src{n % 2}", len(t or "")) for n, t in good.items()]
    return out + [out[5]]


def write(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages_equal_plain_ones(spark, tmp_path):
    docs = odd.clashing(spark.createDataFrame(rows(), odd.SCHEMA))
    write(spark, tmp_path, docs)
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left, seen = read, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, str(tmp_path))
        assert out.columns == docs.columns
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        left = spark.read.parquet(path)
        seen[name] = {r.doc_id: r for r in left.collect()}
        assert all(r.n_chars == len(r.text) and r.words == "own words" for r in seen[name].values())
    judged = {r.doc_id: r for r in quality.judged(read).collect()}
    assert set(seen["quality_rules"]) == {k for k, r in judged.items() if r.kept}
    assert set(judged) - set(seen["quality_rules"]) == {27, 28}
    assert seen["quality_rules"][26].text == text_of(26)
    texts = [(k, r.text) for k, r in seen["quality_rules"].items()]
    classes = dict(expected_classes(texts))
    assert set(seen["near_dedup"]) == set(classes.values())
    assert set(classes) - set(classes.values()) == {20, 21}
    assert set(seen["near_dedup"]) - set(seen["substring_dedup"]) == {24}
    assert odd.spaced(seen["substring_dedup"][22].text) == odd.spaced(text_of(22))
    clean = windows(odd.plain(ITEM), 10)
    kept = {k for k, r in seen["substring_dedup"].items() if not windows(odd.plain(r.text), 10) & clean}
    assert set(seen["benchmark_decontamination"]) == kept
    assert set(seen["substring_dedup"]) - kept == {25}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    words = Counter()
    for r in packed:
        words[r.doc_id] += r.length
    last = seen["benchmark_decontamination"]
    assert words == {k: len(odd.spaced(r.text)) for k, r in last.items()}
    from chorale.llm.packing import Packing

    check_bins(packed, {k: (r.source, r.text) for k, r in last.items()}, Packing())


def test_empty_table(spark, tmp_path):
    write(spark, tmp_path, odd.table(spark).limit(0))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_rows(spark, tmp_path):
    write(spark, tmp_path, odd.table(spark))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= {r[0] for r in odd.rows()}

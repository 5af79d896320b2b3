import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chorale.llm import fill_middle as fm
from tests.llm import odd

UNIT = {"line": r"[^\n]*\n|[^\n]+", "sentence": r"[^\n.!?]*[\n.!?]|[^\n.!?]+", "blank": r"[^\s]*\s|[^\s]+"}


def expected(doc_id, text, unit="line", rate=100, suffix_first=50):
    text = text or ""
    units = re.findall(UNIT[unit], text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < suffix_first:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 128, 5000])
def test_rank_and_select_equal_counting(n):
    codes = np.random.default_rng(n).integers(0, 8, n).astype(np.uint8)
    matrix = fm.WaveletMatrix(codes)
    for code in range(8):
        assert (matrix.rank(code, np.arange(n + 1)) == np.concatenate([[0], np.cumsum(codes == code)])).all()
        places = np.flatnonzero(codes == code)
        assert (matrix.select(code, np.arange(len(places))) == places).all()
    places = np.flatnonzero(np.isin(codes, (1, 2)))
    assert (matrix.after((1, 2), np.arange(1, len(places) + 1)) == places + 1).all()


EXTRA = [
    (900, "a<P>b\nc"),
    (901, "<\n<P\n>S>\n<\nM>"),
    (902, "\n\n\n"),
    (903, "ä\nö\nü\n日本\n𝄞 end"),
    (904, "\r\nno\x0bend. Yes? é!"),
    *((k, "x\n" * (k % 7) + "é" * (k % 3)) for k in range(905, 960)),
]


@pytest.mark.parametrize("unit", sorted(UNIT))
def test_cuts_equal_plain_python_on_odd_texts(spark, unit):
    rows = [(r[0], r[1]) for r in odd.rows()] + EXTRA
    if unit == "blank":
        # Python's \s has more characters than the blanks here.
        rows = [r for r in rows if not re.search(r"[^\S \t\n\v\f\r]", r[1] or "")]
    docs = odd.clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    found = fm.transformed(docs, unit=unit)
    odd.same_rows(found.collect(), [expected(*r, unit=unit) for r in rows])
    back = found.select(fm.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(r.text for r in back) == sorted(t or "" for _, t in rows)


def test_rates_choose_forms(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("one\ntwo\nthree").alias("text"))
    found = fm.transformed(docs, rate=40, suffix_first=10).collect()
    odd.same_rows(found, [expected(k, "one\ntwo\nthree", rate=40, suffix_first=10) for k in range(400)])
    assert 0.3 < sum(r.form != "plain" for r in found) / 400 < 0.5


def test_empty_table_gives_empty_table(spark):
    assert fm.transformed(odd.table(spark).limit(0)).collect() == []

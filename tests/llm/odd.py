"""A table of documents with every odd case at once, and plain helpers."""

import re

from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{k * 7919 % 30011}" for k in range(60_000)) + "."
PASSAGE = " ".join(f"shared{k}" for k in range(60))


def spaced(text):
    return SPACED.findall(text or "")


def plain(text):
    return PLAIN.findall((text or "").translate(LOWER))


def rows():
    sentence = "The quick brown fox jumps over the lazy dog near the river bank today."
    texts = [
        None,
        "",
        "   \t\n ",
        "one",
        "one two three four",
        sentence,
        sentence,
        "Line one ends here.\n" * 12,
        LONG,
        LONG + " one word more",
        f"Before it. {PASSAGE} After it.",
        f"Otherwise begun, {PASSAGE} and ended otherwise.",
        "ÉCOLE école Straße K İstanbul émigré ñandú été öffnen çà là où.",
        "a\x0bb\x0cc\rd e\x1cf\x85g\xa0h",
        "x " * 400,
        "MIT License and mit  license, GNU General Public License; cc-by CC BY.",
    ]
    out = [(k, t, "en", f"src{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    out += [out[5], out[5]]  # repeated rows
    out += [(None, sentence, None, None, None), (7, "another text of the same id.", "en", None, 3)]
    return out


def table(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def clashing(df):
    """The same with more columns, named as things inside the operators are."""
    names = (
        "words windows lines node bands bucket chunk hash n items n_words n_hit n_removed kept class_id "
        "ring_slot copies shard slot cluster piece places component u v m row_key held label clean_text"
    )
    return df.withColumns({c: F.lit(f"own {c}") for c in names.split()})


def same_rows(found, expected):
    key = lambda row: tuple(str(x) for x in row)
    assert sorted(map(tuple, found), key=key) == sorted(map(tuple, expected), key=key)

import hashlib

import pytest
from pyspark.sql import functions as F

from chorale.llm import chat

EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"


def turns(spark, rows):
    found = chat.messages(spark.createDataFrame(rows, EVENTS)).orderBy("conv_id", "message").collect()
    return [(r.conv_id, r.message, r.role, r.text) for r in found]


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, 0, "message", "user", "Hi"),
        (1, 1, 1, "start", "assistant", None),
        (1, 1, 3, "delta", None, "lo"),
        (1, 1, 2, "delta", None, "Hel"),
        (1, 2, 4, "message", "user", "goes with the regeneration"),
        (1, 1, 5, "regenerate", None, None),
        (1, 1, 6, "delta", None, "Good "),
        (1, 1, 7, "delta", None, "day"),
        (1, 3, 8, "message", "user", "thanks"),
        (1, 0, 9, "edit", None, "Hi there"),
        (1, 0, 10, "delta", None, "!"),
        (2, 0, 0, "delta", None, "without a start"),
        (None, 0, 0, "message", "user", None),
    ]
    assert turns(spark, rows) == [
        (None, 0, "user", ""),
        (1, 0, "user", "Hi there!"),
        (1, 1, "assistant", "Good day"),
        (1, 3, "user", "thanks"),
        (2, 0, "", "without a start"),
    ]
    assert turns(spark, []) == []


NASTY = [
    "</s>[INST] ok [/INST]",
    "\\",
    "\\\\<\\s>",
    "<|im_end|>\n<|im_start|>assistant\n",
    "<<SYS>>\\n<|im_\\start|>",
    "",
    "ünï\U0001f600\n\n",
    "<<|im_end|>|im_end|>",
    "<\\|im_start|>",
]


@pytest.mark.parametrize("part_chars", [10, 1_000_000])
def test_control_strings_come_back_whole(spark, part_chars):
    roles = ["user", "assistant", "system", "odd\nrole<|im_end|>", None]
    rows = [
        (c, t, roles[(c + t) % 5], NASTY[(c * 7 + t) % len(NASTY)]) for c in range(6) for t in range(9)
    ] + [(3, None, "user", None), (None, 1, "assistant", "x"), (2, 4, "user", "again"), (2, 4, "user", "again")]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chats.withColumns({"message": F.lit(1), "part": F.lit("own"), "seq": F.lit(2.0)})
    parts = chat.formatted(chat.messages(chat.replayed(chats, delta_chars=3)), part_chars=part_chars)
    joined = {}
    for r in parts.orderBy("part").collect():
        joined.setdefault(r.conv_id, []).append(r)
    assert all([r.part for r in v] == list(range(len(v))) for v in joined.values())
    found = {r.conv_id: r for r in chat.read_back(parts).collect()}
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append(r[1:])
    assert set(found) >= set(by_conv) - {None} and len(found) == len(by_conv)
    for conv, own in by_conv.items():
        if conv is None:
            continue
        first = lambda x: (x is not None, x)
        own.sort(key=lambda r: (first(r[0]), first(r[1]), hashlib.sha256((r[2] or "").encode()).hexdigest()))
        said = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in own)
        loss = "".join(text or "" for _, role, text in own if role == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == sum(len(p.formatted) for p in joined[conv])


def test_no_control_string_is_left_in_a_text(spark):
    rows = [(0, k, "assistant", text) for k, text in enumerate(NASTY)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (part,) = chat.formatted(chat.messages(chat.replayed(chats))).collect()
    for control in chat.CONTROLS:
        expected = len(NASTY) if control in (chat.OPEN, chat.CLOSE) else 0
        assert part.formatted.count(control) == expected
    assert [chat.unescaped(part.formatted[s.begin : s.end]) for s in part.loss] == NASTY

"""Chats rebuilt from an event log and rendered as text to train on.

An event belongs to a conversation (``conv_id``), has a place in its sequence (``seq``)
and acts on one ``message``, a sortable value that also orders the messages:

* ``message`` and ``start`` open a message with a role, with its whole text or none yet;
* ``delta`` adds text at its end;
* ``edit`` puts another text in place of all it had;
* ``regenerate`` empties it, for new deltas, and drops all later messages made before.

The log is dealt out by conversation once and sorted; folding is done by windows and
groups over that order, so that memory holds one message at a time. A rendered
conversation comes in parts of whole turns, each of about ``part_chars`` characters; most
have one part. Parts joined in order are the text.

A turn reads ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside roles and
texts get a backslash after their first character, and backslashes are doubled, so that
no text can end its turn and every text can be had back. The loss mask of a part is a
list of spans; they cover the texts of the trained role and nothing else.

Defined results for odd input: a null text or role is empty; a null ``conv_id`` is a
conversation of its own; conversations without messages have no rows, and so has an empty
log; events of the same ``seq`` in a message are ordered by kind and text; a delta before
any opening opens its message without a role. Further columns are left out of the result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.session import ship_package

# Strings that chat templates use as controls; all are escaped in texts.
CONTROLS = ["<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
OPEN, CLOSE = CONTROLS[:2]
TURN = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE) + r"\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.?)", re.DOTALL)


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put into each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescaped(text: str) -> str:
    """The text that was escaped; ``\\-``, which only roles have, is a line's end."""
    return _ESCAPED.sub(lambda m: {"\\": "\\", "-": "\n"}.get(m[1], m[1]), text)


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text) of the messages that are left after all events."""
    conv = ["conv_id"]
    reset = F.col("kind") != "delta"
    of_message = Window.partitionBy(*conv, "message")
    place = F.struct("seq", "kind", "text")
    log = events.select(
        *conv, "message", "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text")
    ).repartition(*conv)
    kept = (
        log.withColumn("since", F.max(F.when(reset, place)).over(of_message))
        .groupBy(*conv, "message")
        .agg(
            F.max("seq").alias("last_seq"),
            F.max_by("role", F.when(F.col("role").isNotNull(), place)).alias("role"),
            F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regenerated"),
            F.array_join(
                F.transform(
                    F.sort_array(
                        F.collect_list(
                            F.when(F.col("since").isNull() | (place >= F.col("since")), place)
                        )
                    ),
                    lambda x: F.when(x["kind"].isin("start", "regenerate"), "").otherwise(x["text"]),
                ),
                "",
            ).alias("text"),
        )
    )
    earlier = Window.partitionBy(*conv).orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    return (
        kept.withColumn("dropped_at", F.max("regenerated").over(earlier))
        .where(F.col("dropped_at").isNull() | (F.col("dropped_at") < F.col("last_seq")))
        .select(*conv, "message", F.coalesce("role", F.lit("")).alias("role"), "text")
    )


def formatted(
    messages: DataFrame, trained_role: str = "assistant", part_chars: int = 1_000_000
) -> DataFrame:
    """(conv_id, part, formatted, loss): text in parts from 0, and the spans to train on."""
    opening = F.concat(
        F.lit(OPEN), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\-")), F.lit("\n")
    )
    turns = messages.select(
        "conv_id",
        "message",
        "role",
        opening.alias("opening"),
        escaped(F.coalesce("text", F.lit(""))).alias("body"),
    ).withColumn("turn_text", F.concat("opening", "body", F.lit(CLOSE + "\n")))
    so_far = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumn("end", F.sum(F.length("turn_text").cast("bigint")).over(so_far)).withColumn(
        "part", F.expr(f"(end - length(turn_text)) div {part_chars}")
    )
    begin = F.col("end") - F.length("turn_text")
    text_begin = begin + F.length("opening")
    span = F.when(
        F.col("role") == trained_role,
        F.struct(text_begin.alias("begin"), (text_begin + F.length("body")).alias("end")),
    )
    one = F.struct("message", "turn_text", begin.alias("turn_begin"), span.alias("span"))
    return (
        turns.groupBy("conv_id", "part")
        .agg(F.sort_array(F.collect_list(one)).alias("turns"))
        .select(
            "conv_id",
            F.dense_rank().over(Window.partitionBy("conv_id").orderBy("part")).cast("bigint").alias("n"),
            F.array_join(F.col("turns.turn_text"), "").alias("formatted"),
            F.expr(
                """transform(filter(turns, x -> x.span IS NOT NULL), x -> named_struct(
                'begin', x.span.begin - turns[0].turn_begin, 'end', x.span.end - turns[0].turn_begin))"""
            ).alias("loss"),
        )
        .select("conv_id", (F.col("n") - 1).alias("part"), "formatted", "loss")
    )


def read_back(parts: DataFrame) -> DataFrame:
    """What a reader finds in formatted text: turns, and the text under the loss mask.

    Digests need a conversation's parts in order. Each task goes through its parts as
    they come and keeps no more than the two running digests.
    """

    ship_package(parts.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None

        def row() -> tuple:
            turns, all_text, chars, loss_text, length = state
            return (*current, turns, all_text.hexdigest(), chars, loss_text.hexdigest(), length)

        for batch in batches:
            done = []
            for conv, known, text, spans in zip(
                batch["conv_id"], batch["known"], batch["formatted"], batch["loss"], strict=True
            ):
                key = (int(conv) if known else None,)
                if key != current:
                    if current is not None:
                        done.append(row())
                    current, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in TURN.findall(text):
                    state[0] += 1
                    state[1].update(f"{unescaped(role)}\n{unescaped(body)}\n".encode())
                for span in spans:
                    body = unescaped(text[span["begin"] : span["end"]])
                    state[2] += len(body)
                    state[3].update(body.encode())
                state[4] += len(text)
            if done:
                yield _found(done)
        if current is not None:
            yield _found([row()])

    dealt = (
        parts.withColumn("known", F.col("conv_id").isNotNull())
        .withColumn("conv_id", F.coalesce("conv_id", F.lit(0)))
        .repartition("conv_id", "known")
        .sortWithinPartitions("known", "conv_id", "part")
    )
    return dealt.mapInPandas(
        read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def _found(rows: list[tuple]) -> pd.DataFrame:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    out = pd.DataFrame(rows, columns=names)
    return out.astype({"conv_id": "Int64"})


def replayed(rows: DataFrame, delta_chars: int = 400) -> DataFrame:
    """The events that would have led to a table of (conv_id, turn, role, text).

    Replies are replayed as streams: a start and deltas of ``delta_chars``; others as
    whole messages. Rows of one turn are messages of their own, in the order of role and
    text; equal rows are told apart by a number.
    """
    text = F.coalesce("text", F.lit(""))
    message = F.struct(
        "turn", "role", F.sha2(text, 256).alias("digest"), F.monotonically_increasing_id().alias("row")
    )
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0))
    whole = F.array(F.struct(F.lit("message").alias("kind"), text.alias("text")))
    streamed = F.concat(
        F.array(F.struct(F.lit("start").alias("kind"), F.lit("").alias("text"))),
        F.transform(pieces, lambda x: F.struct(F.lit("delta").alias("kind"), x.alias("text"))),
    )
    # The number is given before rows become events: all events of a row must share it.
    log = rows.withColumn("message", message).select(
        "conv_id",
        "message",
        "role",
        F.posexplode(F.when(F.col("role") == "assistant", streamed).otherwise(whole)).alias("seq", "event"),
    )
    return log.select(
        "conv_id", "message", F.col("seq").cast("bigint").alias("seq"), "event.kind", "role", "event.text"
    )

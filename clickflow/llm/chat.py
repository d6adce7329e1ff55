"""Chat formatting with Spark expressions only.

Turns are grouped by conversation, collected as structs and sorted; array aggregation merges adjacent
turns of one role into a message; messages are concatenated:

    <|turn|>role<|text|>text(<|also|>text of a merged turn)*<|end|>

Control strings inside roles and texts (the template's own and other common ones) are escaped by
putting the sign ``ESCAPE`` behind their first character; one that already has such signs gets one
more. So no control string survives inside a text, and taking one sign away restores it exactly.

The loss mask is a list of (start, length) in code points of the formatted text, one for each
assistant turn. ``read_back`` recovers the turns and the text under the mask from the output alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, ALSO, END = "<|turn|>", "<|text|>", "<|also|>", "<|end|>"
ESCAPE = "␛"
# What else may never appear unescaped inside a text.
FOREIGN = ["<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>", "<|im_start|>", "<|im_end|>"]
_RESTS = "|".join(
    "".join("\\" + c if c in "|[]/" else c for c in s[1:]) for s in [TURN, TEXT, ALSO, END, *FOREIGN])


def _literal(s: str) -> str:
    return "r'" + s + "'"


def _escaped(column: str) -> str:
    return f"regexp_replace({column}, {_literal(f'([<\\[])({ESCAPE}*)({_RESTS})')}, '$1{ESCAPE}$2$3')"


def _restored(column: str) -> str:
    return f"regexp_replace({column}, {_literal(f'([<\\[]){ESCAPE}({ESCAPE}*)({_RESTS})')}, '$1$2$3')"


def _marker(s: str) -> str:
    return _literal("".join("\\" + c if c in "|" else c for c in s))


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row for each conv_id: ``formatted`` and ``loss_spans`` (start, length in code points).

    Takes conv_id, turn, role, text; other columns are ignored. Order is by turn, ties by role, then
    text; nulls first. A null role or text is the empty string; repeated rows are turns like any
    other; rows with a null conv_id form one conversation. An empty table gives no rows."""
    sorted_turns = turns.groupBy("conv_id").agg(
        F.expr("sort_array(collect_list(struct(turn, coalesce(role, '') AS role, coalesce(text, '') AS text)))").alias("turns"))
    # A message is a slice of the turns between two changes of role: each turn is copied once. What is read at
    # many places is bound by a transform over an array of one, so that it is evaluated once.
    merged = sorted_turns.select("conv_id", F.expr("""
        flatten(transform(array(turns), ts -> flatten(transform(
            array(filter(sequence(0, size(ts) - 1), i -> i = 0 OR get(ts, i).role != get(ts, i - 1).role)), begins ->
                transform(begins, (b, i) -> struct(get(ts, b).role AS role, transform(
                    slice(ts, b + 1, coalesce(get(begins, i + 1), size(ts)) - b), t -> t.text) AS texts))))))""").alias("messages"))
    pieces = merged.select("conv_id", F.size("messages").alias("n_messages"), F.expr(f"""
        flatten(transform(messages, m -> concat(
            array(struct(concat('{TURN}', {_escaped('m.role')}, '{TEXT}') AS text, false AS loss)),
            flatten(transform(m.texts, (t, i) -> concat(
                IF(i > 0, array(struct('{ALSO}' AS text, false AS loss)), array()),
                array(struct({_escaped('t')} AS text, m.role = '{loss_role}' AS loss))))),
            array(struct('{END}' AS text, false AS loss)))))""").alias("pieces"))
    # Where each piece starts: running sums within blocks of some square root of the pieces, and of the blocks.
    starts = """flatten(transform(array(CAST(ceil(sqrt(size(ps))) AS INT)), width -> flatten(transform(
        array(transform(sequence(0, (size(ps) - 1) div width), b -> aggregate(
            slice(ps, CAST(b * width + 1 AS INT), width), array(0L), (s, p) -> concat(s, array(element_at(s, -1) + length(p.text)))))),
        sums -> flatten(transform(
            array(aggregate(sums, array(0L), (s, x) -> concat(s, array(element_at(s, -1) + element_at(x, -1))))), bases ->
            flatten(transform(sums, (x, b) -> transform(slice(x, 1, size(x) - 1), s -> s + get(bases, b))))))))))"""
    return pieces.select(
        "conv_id", F.col("n_messages").cast("bigint").alias("n_messages"),
        F.expr("array_join(transform(pieces, p -> p.text), '')").alias("formatted"),
        F.expr(f"""flatten(transform(array(pieces), ps -> flatten(transform(array({starts}), starts ->
            transform(filter(sequence(0, size(ps) - 1), i -> get(ps, i).loss), i -> struct(
                get(starts, i) AS start, CAST(length(get(ps, i).text) AS BIGINT) AS length))))))""").alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns`` (array of role, text) parsed out of the formatted text, and
    ``loss_text``: all text under the loss mask, unescaped, in order, with nothing between."""
    return formatted.withColumn(
        "turns", F.expr(f"""
        flatten(transform(filter(split(formatted, {_marker(END)}), m -> m != ''), m ->
            transform(split(split(m, {_marker(TEXT)})[1], {_marker(ALSO)}), t -> struct(
                {_restored(f"substring(split(m, {_marker(TEXT)})[0], {len(TURN) + 1})")} AS role,
                {_restored('t')} AS text))))""")).withColumn(
        "loss_text", F.expr(
            f"array_join(transform(loss_spans, s -> {_restored('substring(formatted, s.start + 1, s.length)')}), '')"))


def digest(turns: DataFrame) -> DataFrame:
    """Read back from the formatted text: conv_id, n_turns, turns_sha256 (role, newline, text, newline
    for each turn), loss_chars, loss_sha256, formatted_chars, n_messages (after merging)."""
    return read_back(format_conversations(turns)).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.expr(r"sha2(array_join(transform(turns, t -> concat(t.role, '\n', t.text, '\n')), ''), 256)").alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), "n_messages")

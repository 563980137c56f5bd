"""Chat formatting: one training text per conversation, with its loss mask.

The turns of a conversation are collected as structs and sorted, adjacent turns of one role are
merged by array functions, and everything is concatenated by Spark expressions.

Template: a run of turns of one role is a block ``### Role: `` followed by its texts, each
closed by ``</turn>``; a line feed ends the block.  Inside texts and roles ``\\`` and ``#`` get a
backslash before them and ``</turn>`` becomes ``<\\/turn>``, in roles ``:`` becomes ``\\c``.  No
control string can therefore appear inside a text, and the formatted text splits back into the
very turns it was made of.

Defined results: turns are sorted by (turn, role, text), nulls first, so ties do not depend on
the order of rows and repeated rows stay repeated; a null text or role counts as empty; rows
without a conversation id form one conversation with a null id; an empty table gives an empty
result; only the four named columns are read, so further columns cannot clash.  A conversation
is one value of one row: it has to fit into a string (2 GB); turns are gathered with map-side
partial collection.  Work grows with the turns to the power of 1.5 at most: offsets and spans are
worked out in runs of about the square root of their number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.operators.columns import quoted

END = "</turn>"
HEAD = "### "
AFTER_ROLE = ": "


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _width(items: Column) -> Column:
    return F.greatest(F.ceil(F.sqrt(F.size(items))), F.lit(1)).cast("int")


def _runs(items: Column, width: Column) -> Column:
    """Numbers of the runs of ``width`` items; of no items there is one empty run."""
    count = F.greatest(F.ceil(F.size(items) / width).cast("int"), F.lit(1))
    return F.sequence(F.lit(0), count - 1)


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _sums_before(numbers: Column) -> Column:
    """Sum of all entries before each one: those of its run, and one sum per run before it."""
    width = _width(numbers)
    sums = F.transform(_runs(numbers, width), lambda r: _total(F.slice(numbers, r * width + 1, width)))
    before = _once(sums, lambda s: F.transform(s, lambda _, r: _total(F.slice(s, F.lit(1), r))))

    def entry(at: Column, i: Column) -> Column:
        run = (i / width).cast("int")
        return at[run] + _total(F.slice(numbers, run * width + 1, i - run * width))

    return _once(before, lambda at: F.transform(numbers, lambda _, i: entry(at, i)))


def escaped(text: Column) -> Column:
    for plain, safe in (("\\", "\\\\"), ("#", "\\#"), (END, "<\\/turn>")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(":"), F.lit("\\c"))


def _plain_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\")  # between escaped backslashes
    plain = F.transform(
        parts,
        lambda x: F.replace(F.replace(x, F.lit("\\c"), F.lit(":")), F.lit("\\"), F.lit("")),
    )
    return F.array_join(plain, "\\")


def format_conversations(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``loss_spans``.

    ``loss_spans`` are (start, length) in code points of ``formatted``, one for each turn of
    ``learned_role``, covering its escaped text and nothing else.
    """
    rows = conversations.select(
        quoted(conv).alias("conv"),
        F.struct(
            quoted(turn).alias("turn"),
            F.coalesce(quoted(role), F.lit("")).alias("role"),
            F.coalesce(quoted(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    gathered = rows.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    # where a block begins: the first turn, or one whose role differs from the turn before
    last = F.size("turns") - 1
    starts = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.col("turns")[i - 1]["role"]),
    )
    cut = gathered.withColumn("starts", starts)

    def block(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get("starts", k + 1), F.size("turns"))
        inside = F.slice("turns", start + 1, stop - start)
        return F.struct(
            F.col("turns")[start]["role"].alias("role"),
            F.transform(inside, lambda x: escaped(x["text"])).alias("texts"),
        )

    merged = cut.select("conv", F.transform("starts", block).alias("blocks"))

    def written(b: Column) -> Column:
        return F.concat(
            F.lit(HEAD), _escaped_role(b["role"]), F.lit(AFTER_ROLE),
            F.array_join(b["texts"], END), F.lit(END + "\n"),
        )

    # lengths of the pieces in order: what stands before a text, the text, and what ends a block
    def pieces(b: Column) -> Column:
        before = F.length(_escaped_role(b["role"])) + len(HEAD) + len(AFTER_ROLE)
        return F.transform(
            b["texts"],
            lambda x, k: F.struct(
                F.when(k == 0, before).otherwise(F.lit(len(END))).alias("gap"),
                F.length(x).alias("length"),
                F.when(k == F.size(b["texts"]) - 1, len(END) + 1).otherwise(F.lit(0)).alias("tail"),
                (b["role"] == learned_role).alias("learned"),
            ),
        )

    laid = merged.select(
        "conv",
        F.array_join(F.transform("blocks", written), "").alias("formatted"),
        F.flatten(F.transform("blocks", pieces)).alias("pieces"),
    )

    def span(p: Column, k: Column, starts: Column) -> Column:
        return F.struct(
            (starts[k] + p["gap"]).alias("start"), p["length"].alias("length"), p["learned"].alias("learned")
        )

    lengths = F.transform("pieces", lambda p: p["gap"] + p["length"] + p["tail"])
    starts = _once(lengths, _sums_before)
    spans = _once(starts, lambda at: F.transform("pieces", lambda p, k: span(p, k, at)))
    learned = F.transform(
        F.filter(spans, lambda s: s["learned"]),
        lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")),
    )
    return laid.select(F.col("conv").alias(conv), "formatted", learned.alias("loss_spans"))


def turns_of(formatted: Column) -> Column:
    """The turns a formatted text was made of: array of (role, text)."""

    def read(b: Column, k: Column, count: Column) -> Column:
        first = F.when(k == 0, F.substring(b, len(HEAD) + 1, F.length(b))).otherwise(b)
        colon = F.instr(first, AFTER_ROLE)
        role = _plain_role(F.substring(first, F.lit(1), colon - 1))
        body = F.substring(first, colon + len(AFTER_ROLE), F.length(first))
        last = k == count - 1
        body = F.when(last, F.substring(body, F.lit(1), F.length(body) - len(END) - 1)).otherwise(body)
        return _once(
            role,
            lambda r: F.transform(
                F.split(body, END), lambda x: F.struct(r.alias("role"), unescaped(x).alias("text"))
            ),
        )

    blocks = F.filter(F.split(formatted, END + "\n" + HEAD), lambda b: F.length(b) > 0)
    return _once(
        blocks, lambda all_: F.flatten(F.transform(all_, lambda b, k: read(b, k, F.size(all_))))
    )


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between the spans.

    Spans are read in runs: the part of the text that a run covers is cut out once."""

    def covered(text: Column, run: Column) -> Column:
        first = run[0]["start"]
        last = F.element_at(run, -1)
        part = F.substring(text, first + 1, last["start"] + last["length"] - first)
        return _once(
            part,
            lambda cut: F.array_join(
                F.transform(run, lambda s: unescaped(F.substring(cut, s["start"] - first + 1, s["length"]))), ""
            ),
        )

    def read(text: Column, all_: Column) -> Column:
        width = _width(all_)
        return F.array_join(
            F.transform(
                _runs(all_, width),
                lambda r: _once(F.slice(all_, r * width + 1, width), lambda run: covered(text, run)),
            ),
            "",
        )

    whole = _once(formatted, lambda text: _once(spans, lambda all_: read(text, all_)))
    return F.when(F.size(spans) == 0, "").otherwise(whole)

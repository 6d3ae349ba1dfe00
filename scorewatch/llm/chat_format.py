"""Chat formatting with a grammar round trip, DataFrame functions only.

A conversation's turns are rendered one after the other as

    <|im_start|>role LF text <|im_end|> LF

(the mark strings are parameters of ``Template``). The grammar is
deterministic: a role holds no LF and no ``<``, a text holds no control string
(nothing that begins like a mark, ``<|``), so a rendering has one reading.
The parser undoes escapes wherever they stand.

Rendering tries the plain form first, parses what it rendered and compares the
recovered turn with the source; while they differ, more of the turn is escaped:
the text, then the role, then both. An escape puts a backslash into ``<|``, and
one more into ``<\\|``, ``<\\\\|`` and so on; in a role it names the backslash,
the LF and ``<``. Blocks begin with the open mark and end with an LF, which is
in no mark, so a conversation of turns that read back alone reads back whole;
that is checked once more on the assembled text, and a difference is an error.

The loss mask covers the texts of the loss roles. Its spans are given in code
points and in bytes of the rendered text; reading by bytes cuts a long
conversation in time that grows with its length only.

Turns are rendered and reparsed as rows, before any grouping. One exchange by
conversation follows; the places of the spans are running totals over it.

Defined cases: null texts and roles are empty; turns of equal number are
ordered by role, then text, null numbers come first; repeated rows are turns of
their own; a null conversation id is a conversation; very long texts are
handled by linear string functions; a conversation's rendering is one value, so
it is limited by what one row can hold (2 GB); an empty table gives an empty
result; columns of the input other than the four named ones are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``mark`` begins every control string; texts hold none in their plain form."""

    open: str = "<|im_start|>"
    close: str = "<|im_end|>"
    mark: str = "<|"
    loss_roles: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.when(F.instr(text, "<\\") > 0, F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")).otherwise(text)


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("<"), F.lit("\\l"))


def unescape_role(role: Column) -> Column:
    """Named characters back, from left to right: between escaped backslashes
    a backslash begins a name."""
    plain = lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\l"), F.lit("<"))
    return F.when(F.instr(role, "\\") > 0,
                  F.array_join(F.transform(F.split(role, r"\\\\", -1), plain), "\\")).otherwise(role)


def _block(role: Column, text: Column, template: Template) -> Column:
    return F.concat(F.lit(template.open), role, F.lit("\n"), text, F.lit(f"{template.close}\n"))


def parse(formatted: Column, template: Template = CHATML) -> Column:
    """The turns of a rendering, array of struct(role, text); null if the
    grammar refuses it."""
    tail = f"{template.close}\n"
    pieces = F.split(formatted, re.escape(template.open), -1)
    role = lambda x: F.substring_index(x, "\n", 1)
    body = lambda x: F.substr(x, F.length(role(x)) + 2, F.length(x) - F.length(role(x)) - (1 + len(tail)))
    good = lambda x: (x.endswith(tail) & (F.instr(x, "\n") < F.length(x) - len(tail) + 1)
                      & ~role(x).contains("<") & ~body(x).contains(template.mark))
    blocks = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.when((F.element_at(pieces, 1) == "") & F.forall(blocks, good),
                  F.transform(blocks, lambda x: F.struct(unescape_role(role(x)).alias("role"), unescape_text(body(x)).alias("text"))))


def _rendered(role: Column, text: Column, template: Template) -> Column:
    """struct(role, text) as they stand in the rendering: the least escaped
    form that reads back as the source."""

    def attempt(r: Column, t: Column) -> Column:
        back = parse(_block(r, t, template), template)
        same = (F.size(back) == 1) & (back[0]["role"] == role) & (back[0]["text"] == text)
        return F.when(same, F.struct(r.alias("role"), t.alias("text")))

    return F.coalesce(attempt(role, text), attempt(role, escape_text(text)), attempt(escape_role(role), text),
                      attempt(escape_role(role), escape_text(text)))


def _digest(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(role, F.lit("\n"), text), 256)


def formatted(rows: DataFrame, template: Template = CHATML, conv_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, n_turns, n_escaped (turns
    that needed an escape) and loss_spans, an array of struct(start, length,
    byte_start, byte_length), from 0."""
    source = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                         F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    made = source.select("conv_id", "turn", "role", _rendered(F.col("role"), F.col("text"), template).alias("as"),
                         _digest(F.col("role"), F.col("text")).alias("digest"),
                         F.col("role").isin(*template.loss_roles).alias("loss"), F.col("text").alias("source"))
    made = made.select(
        "conv_id", "turn", "role", "digest", "loss",
        ((F.col("as.role") != F.col("role")) | (F.col("as.text") != F.col("source"))).alias("escaped"),
        F.col("as.text").alias("body"), _block(F.col("as.role"), F.col("as.text"), template).alias("block"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", unescape_text(F.col("body")))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    tail = len(template.close) + 1  # and as many bytes where the mark is ASCII
    tail_bytes = len(template.close.encode()) + 1
    placed = (made.withColumn("at", F.row_number().over(order))
              .withColumn("end", F.sum(F.length("block")).over(so_far))
              .withColumn("end_bytes", F.sum(F.octet_length("block")).over(so_far)))
    span = F.when(F.col("loss"), F.struct(
        (F.col("end") - tail - F.length("body")).alias("start"), F.length("body").cast("long").alias("length"),
        (F.col("end_bytes") - tail_bytes - F.octet_length("body")).alias("byte_start"),
        F.octet_length("body").cast("long").alias("byte_length")))
    turns = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "block", "digest", span.alias("span")))).alias("turns"),
        F.sum(F.col("escaped").cast("long")).alias("n_escaped"))
    whole = turns.select("conv_id", "n_escaped", F.array_join(F.transform("turns", lambda t: t["block"]), "").alias("formatted"),
                         F.transform("turns", lambda t: t["digest"]).alias("digests"),
                         F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"))
    read = F.transform(parse(F.col("formatted"), template), lambda t: _digest(t["role"], t["text"]))
    return whole.select(
        "conv_id",
        F.when(read.eqNullSafe(F.col("digests")), F.col("formatted"))
        .otherwise(F.raise_error(F.lit("a conversation does not read back from its rendering"))).alias("formatted"),
        F.size("digests").cast("long").alias("n_turns"), "n_escaped", "loss_spans")


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, in order."""
    raw = formatted.cast("binary")
    cut = lambda s: F.substr(raw, (s["byte_start"] + 1).cast("int"), s["byte_length"].cast("int")).cast("string")
    return F.array_join(F.transform(spans, lambda s: unescape_text(cut(s))), "")


def read_back(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """What ``formatted`` made, read by the parser and the mask: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    read = conversations.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
                                parse(F.col("formatted"), template).alias("turns"),
                                loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       "formatted_chars")

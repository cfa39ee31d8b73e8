"""Chat formatting: schema fingerprints select declarative mappings to turns.

Every row's layout is recognised by the set of nested field paths that carry a
value in it; the hash of that set is the row's schema fingerprint.  A mapping
declares required and optional paths and an expression for the turns; it owns
the fingerprints of all its path sets.  Rows of many layouts may stand in one
table (a JSON column, or columns that only some rows fill).

Template, one block per turn:

    ### <role>
    <text>
    </turn>

Escapes make it reversible: in a role ``\\`` becomes ``\\s`` and a line feed
``\\l``; in a text every ``### `` and ``</turn>`` gets 2k+1 backslashes where k
stood before it.  So no control string of a text is bare, and a bare block end
after a line feed is a block end.

All of it is column expressions: no Python runs on the data.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from lodestar.llm.common import materialize

HEAD, END = "### ", "</turn>"
_TAIL = f"\n{END}\n"
_CONTROL = r"(### |</turn>)"


@dataclass(frozen=True)
class Mapping:
    """A layout: the paths that make it up, and its turns as a SQL expression
    of type array<struct<role string, text string>>."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    turns: str

    def fingerprints(self) -> list[str]:
        extras = chain.from_iterable(combinations(self.optional, n) for n in range(len(self.optional) + 1))
        return [fingerprint_of(self.required + e) for e in extras if self.required + e]


def fingerprint_of(paths: tuple[str, ...]) -> str:
    """Hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


MAPPINGS = (
    Mapping("turn_row", (), ("turn", "role", "text"), "array(struct(role, text))"),
    Mapping("messages", ("messages[].role",), ("messages[].content",),
            "transform(messages, m -> struct(m.role AS role, m.content AS text))"),
    Mapping("conversations", ("conversations[].from",), ("conversations[].value",),
            "transform(conversations, m -> struct(CASE m.from WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant'"
            " ELSE m.from END AS role, m.value AS text))"),
    Mapping("prompt", ("prompt",), ("completion", "system"),
            "filter(array(struct('system' AS role, system AS text), struct('user' AS role, prompt AS text),"
            " struct('assistant' AS role, coalesce(completion, '') AS text)), t -> t.role <> 'system' OR t.text IS NOT NULL)"),
    Mapping("instruction", ("instruction",), ("input", "output"),
            "array(struct('user' AS role, concat_ws('\\n\\n', instruction, nullif(input, '')) AS text),"
            " struct('assistant' AS role, coalesce(output, '') AS text))"),
)

_STRING = T.StringType()


def _pair(a: str, b: str) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(a, _STRING), T.StructField(b, _STRING)]))


# All fields that a mapping may name; what a table or a JSON text lacks is null.
FIELDS = T.StructType([
    T.StructField("turn", T.LongType()), T.StructField("role", _STRING), T.StructField("text", _STRING),
    T.StructField("messages", _pair("role", "content")), T.StructField("conversations", _pair("from", "value")),
    *[T.StructField(n, _STRING) for n in ("system", "prompt", "completion", "instruction", "input", "output")],
])


def _present(path: str) -> Column:
    """Does the row carry a value at this path (for arrays: in any element)?"""
    outer, _, inner = path.partition("[].")
    if not inner:
        return F.col(f"`{path}`").isNotNull()
    return F.coalesce(F.exists(F.col(outer), lambda x: x.getField(inner).isNotNull()), F.lit(False))


def _fitting(df: DataFrame, field: T.StructField) -> Column:
    """The column of ``df`` named like the field, if its type fits; null otherwise."""
    have = {f.name.lower(): f for f in df.schema.fields}.get(field.name)
    null = F.lit(None).cast(field.dataType)
    if have is None:
        return null
    col, kind = F.col(f"`{have.name}`"), have.dataType
    if isinstance(field.dataType, T.ArrayType):
        inner = kind.elementType if isinstance(kind, T.ArrayType) else None
        if not isinstance(inner, T.StructType):
            return null
        names = {f.name.lower(): f.name for f in inner.fields if isinstance(f.dataType, T.StringType)}
        value = lambda x, n: x.getField(names[n]) if n in names else F.lit(None).cast("string")
        return F.transform(col, lambda x: F.struct(*[value(x, n).alias(n) for n in field.dataType.elementType.names]))
    if isinstance(field.dataType, T.StringType):
        return col.cast("string") if isinstance(kind, T.StringType) else null
    return col.cast(field.dataType) if isinstance(kind, T.IntegralType) else null


def _paths() -> list[str]:
    out = []
    for f in FIELDS.fields:
        inner = f.dataType.elementType.names if isinstance(f.dataType, T.ArrayType) else None
        out += [f"{f.name}[].{n}" for n in inner] if inner else [f.name]
    return sorted(out)


def schema_fingerprint() -> Column:
    """Hash of the paths present in a row (columns as in ``FIELDS``)."""
    # a row with a turn, role or text is one turn, whatever other columns its table fills
    turn = F.col("turn").isNotNull() | F.col("role").isNotNull() | F.col("text").isNotNull()
    own = ("turn", "role", "text")
    paths = F.concat_ws("\n", *[F.when(_present(p) if p in own else _present(p) & ~turn, F.lit(p)) for p in _paths()])
    return F.substring(F.sha2(F.encode(paths, "UTF-8"), 256), 1, 16)


def canonical_turns(df: DataFrame, conv_id: str = "conv_id", json: str | None = None,
                    mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """conv_id, turn_no, item, role, text, layout: one row per turn.

    The layout is read from the columns of ``df``, or from a column of JSON
    texts.  ``turn_no`` is the row's ``turn`` (null for layouts that hold whole
    conversations), ``item`` the position inside the row.  A row whose
    fingerprint no mapping owns is kept as one turn with null layout, null
    role and null text.  Fields beyond ``FIELDS`` are ignored, and so are
    columns that are named like a field but have another type (a string
    ``messages``).  A row that has a turn, role or text is one turn even if
    further columns of its table are filled.  Null values stay null here and
    count as empty when they are formatted; texts may be of any length; equal
    rows are turns of their own; an empty table gives no turn.
    """
    if json is None:
        fields = [_fitting(df, f).alias(f.name) for f in FIELDS.fields]
        rows = df.select(F.col(conv_id).alias("conv_id"), *fields)
    else:
        rows = df.select(F.col(conv_id).alias("conv_id"), F.from_json(F.col(json), FIELDS).alias("j")).select("conv_id", "j.*")
    owner = {fp: m.name for m in mappings for fp in m.fingerprints()}
    lookup = F.create_map(*[F.lit(x) for pair in owner.items() for x in pair])
    rows = rows.withColumn("layout", F.try_element_at(lookup, schema_fingerprint()))
    turns = F.expr("array(struct(CAST(NULL AS STRING) AS role, CAST(NULL AS STRING) AS text))")
    for m in mappings:
        turns = F.when(F.col("layout") == m.name, F.expr(m.turns)).otherwise(turns)
    item = F.posexplode(turns).alias("item", "t")
    return rows.select("conv_id", F.col("turn").alias("turn_no"), "layout", item).select(
        "conv_id", "turn_no", "item", F.col("t.role").alias("role"), F.col("t.text").alias("text"), "layout")


def escape_text(text: Column) -> Column:
    # a run of backslashes is tried from its begin only, and taken whole: linear in any text
    return F.regexp_replace(text, r"(?<!\\)(\\*+)" + _CONTROL, r"$1$1\\$2")


def unescape_text(text: Column) -> Column:
    # pairs before a control string become one, each found where the last one ended (\G); then its own backslash goes
    pairs = r"(?:\G(?!^)|(?<!\\)(?=\\*+" + _CONTROL + r"))\\\\"
    return F.regexp_replace(F.regexp_replace(text, pairs, r"\\"), r"\\" + _CONTROL, "$1")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\l"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\l"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def format_turns(turns: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans: one row per conversation.

    ``loss_spans`` has one (start, end) per turn, in code points of
    ``formatted``: the text of a ``learn_from`` turn, null for other turns.
    Turns are ordered by turn_no (nulls last), item, role, text; null roles
    and texts count as empty; a null conv_id is a conversation of its own.
    Escaping happens per turn, before the only shuffle; a conversation is one
    training record and must fit one row.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    head, body = F.concat(F.lit(HEAD), escape_role(role), F.lit("\n")), escape_text(text)
    blocks = turns.select(
        "conv_id", F.struct(F.col("turn_no").isNull().alias("last"), "turn_no", "item", role.alias("r"), text.alias("t")).alias("o"),
        F.concat(head, body, F.lit(_TAIL)).alias("block"), F.length(head).alias("head"), F.length(body).alias("body"))
    order = Window.partitionBy("conv_id").orderBy("o")
    size = F.length("block").cast("long")
    placed = blocks.withColumn("at", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size)
    start = F.col("at") + F.col("head")
    span = F.when(F.col("o.r") == learn_from, F.struct(start.alias("start"), (start + F.col("body")).alias("end")))
    placed = placed.select("conv_id", F.struct("at", "block", span.alias("span"), F.row_number().over(order).alias("n")).alias("b"))
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("b.n", "b.block", "b.span"))).alias("b"))
    return gathered.select("conv_id", F.array_join(F.col("b.block"), "").alias("formatted"), F.col("b.span").alias("loss_spans"))


def parse_turns(formatted: DataFrame) -> DataFrame:
    """conv_id, n, role, text, loss_text: the turns read back from formatted records.

    ``loss_text`` is the unescaped text under the record's loss spans in this
    turn, null where there is none."""
    blocks = F.split(F.col("formatted"), _TAIL.replace("/", "\\/"))
    parts = formatted.select("conv_id", F.posexplode(F.arrays_zip(F.slice(blocks, F.lit(1), F.size(blocks) - 1).alias("block"), "loss_spans")).alias("n", "z"))
    parts = parts.select("conv_id", "n", F.col("z.block").alias("block"), F.col("z.loss_spans").alias("span"))
    size = (F.length("block") + len(_TAIL)).cast("long")
    begin = F.sum(size).over(Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)) - size
    line = F.instr(F.col("block"), "\n")
    under = F.substring(F.col("block"), (F.col("span.start") - F.col("begin") + 1).cast("int"),
                        (F.col("span.end") - F.col("span.start")).cast("int"))
    return parts.withColumn("begin", begin).select(
        "conv_id", "n", unescape_role(F.substring("block", F.lit(len(HEAD) + 1), line - len(HEAD) - 1)).alias("role"),
        unescape_text(F.substring(F.col("block"), line + 1, F.length("block"))).alias("text"),
        F.when(F.col("span").isNotNull(), unescape_text(under)).alias("loss_text"))


def digests(formatted: DataFrame) -> DataFrame:
    """Per record, from what ``parse_turns`` reads back: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    turn = F.concat(F.col("role"), F.lit("\n"), F.col("text"), F.lit("\n"))
    back = parse_turns(formatted).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", turn.alias("turn"), "loss_text"))).alias("t"))
    loss = F.array_join(F.col("t.loss_text"), "")
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    sizes = formatted.select(F.col("conv_id").alias("id"), F.length("formatted").cast("long").alias("formatted_chars"))
    out = back.select("conv_id", F.size("t").cast("long").alias("n_turns"), sha(F.array_join(F.col("t.turn"), "")).alias("turns_sha256"),
                      F.length(loss).cast("long").alias("loss_chars"), sha(loss).alias("loss_sha256"))
    return out.join(sizes, F.col("conv_id").eqNullSafe(F.col("id"))).drop("id")


def write_formatted(turns: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """The formatted records, written to the shared folder and read again."""
    return materialize(format_turns(turns, learn_from), "chat")

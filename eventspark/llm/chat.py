"""Chat formatting by schema fingerprints, with DataFrame functions only.

Records of mixed layouts (prompt and completion, instruction sets, lists of messages) sit in one nullable struct, as
Spark's JSON reader merges them.  A record's fingerprint is the hash of the sorted nested field paths it fills, array
steps written ``[]``.  Each declared :class:`Layout` names its paths, so its fingerprints are known beforehand, and the
fingerprint alone selects the layout that turns a record into canonical turns.  A record of no declared layout keeps
its row, with null layout, turns and text.

The template writes a turn as ``### <role>:\\n<text></turn>\\n``.  Inside texts and roles a backslash is doubled and a
control string gets a backslash after its first character, so control strings stand only where the template put them
and every text can be read back exactly.  ``loss_spans`` has one entry per turn: the code points ``[start, end)`` of an
assistant's escaped text in the whole, else null.

Nulls and odd inputs: a null role or text inside a turn counts as empty; a conversation without turns is an empty text.
A conversation is one row and must fit in one; other columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, HEAD, END = "### ", ":\n", "</turn>"
_CLOSE = END + "\n"


@dataclass(frozen=True)
class Layout:
    """How one record layout becomes turns.

    ``fields``: ``(role, path)`` in order; or ``items``: an array path whose elements have ``role_key`` and
    ``text_key``, roles renamed by ``roles``.  Paths in ``optional`` may be missing.
    """
    name: str
    fields: tuple[tuple[str, str], ...] = ()
    items: str = ""
    role_key: str = "role"
    text_key: str = "content"
    roles: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = field(default=())

    def paths(self) -> list[str]:
        if self.items:
            return [f"{self.items}[].{self.role_key}", f"{self.items}[].{self.text_key}"]
        return [p for _, p in self.fields]

    def fingerprints(self) -> list[str]:
        """Path lists (joined) that select this layout."""
        out = []
        for n in range(len(self.optional) + 1):
            out += ["\n".join(sorted(set(self.paths()) - set(gone))) for gone in combinations(self.optional, n)]
        return out


LAYOUTS = (
    Layout("prompt", (("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)),
    Layout("instruction", (("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
           optional=("system", "input")),
    Layout("question", (("user", "question"), ("assistant", "answer.text"))),
    Layout("messages", items="messages", optional=("messages[].role",)),
    Layout("share", items="conversations", role_key="from", text_key="value",
           roles=(("human", "user"), ("gpt", "assistant"))),
)


def _filled(value: Column, kind: T.DataType, path: str) -> list[tuple[str, Column]]:
    """Leaf paths below a value, each with whether a record fills it."""
    if isinstance(kind, T.StructType):
        return [x for f in kind.fields
                for x in _filled(value[f.name], f.dataType, f"{path}.{f.name}" if path else f.name)]
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        leaves = _filled(F.lit(None).cast(kind.elementType), kind.elementType, f"{path}[]")
        return [(p, _some(value, kind.elementType, f"{path}[]", n)) for n, (p, _) in enumerate(leaves)]
    return [(path, value.isNotNull())]


def _some(items: Column, element: T.StructType, path: str, leaf: int) -> Column:
    """Whether any element of an array fills its ``leaf``-th leaf."""
    return F.coalesce(F.exists(items, lambda x: _filled(x, element, path)[leaf][1]), F.lit(False))


def fingerprint(record: Column, schema: T.StructType) -> Column:
    """Hash of the sorted nested paths that a record fills."""
    leaves = sorted(_filled(record, schema, ""), key=lambda x: x[0])
    return F.xxhash64(F.concat_ws("\n", *[F.when(has, F.lit(p)) for p, has in leaves]))


def _at(record: Column, schema: T.StructType, path: str) -> Column | None:
    kind: T.DataType = schema
    for step in path.split("."):
        if not isinstance(kind, T.StructType) or step not in kind.names:
            return None
        record, kind = record[step], kind[step].dataType
    return record


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _turns(layout: Layout, record: Column, schema: T.StructType) -> Column | None:
    if layout.items:
        items = _at(record, schema, layout.items)
        if items is None:
            return None
        keys = schema[layout.items].dataType.elementType.names

        def one(x: Column) -> Column:
            role = x[layout.role_key] if layout.role_key in keys else F.lit(None).cast("string")
            renamed = F.coalesce(*[F.when(role == a, F.lit(b)) for a, b in layout.roles], role)
            return _turn(renamed, x[layout.text_key])

        return F.transform(items, one)
    values = [(role, _at(record, schema, path)) for role, path in layout.fields]
    if all(v is None for _, v in values):
        return None
    return F.filter(F.array(*[F.struct(F.lit(role).alias("role"), v.alias("text")) for role, v in values
                              if v is not None]), lambda x: x["text"].isNotNull())


def canonical_turns(df: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``df`` with ``layout`` (name) and ``turns`` (array of role and text) of its struct column ``record``."""
    schema = df.schema[record].dataType
    df = df.withColumn("fingerprint", fingerprint(F.col(record), schema))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for layout in layouts:
        made = _turns(layout, F.col(record), schema)
        if made is not None:
            fits = F.lit(False)
            for paths in layout.fingerprints():
                fits = fits | (F.col("fingerprint") == F.xxhash64(F.lit(paths)))
            name = F.when(fits, F.lit(layout.name)).otherwise(name)
            turns = F.when(fits, made).otherwise(turns)
    return df.withColumns({"layout": name, "turns": turns})


def _escape(text: Column, controls: Sequence[str]) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in controls:
        text = F.replace(text, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return text


def _unescape(text: Column) -> Column:
    parts = F.split(text, "\\\\\\\\", -1)  # at doubled backslashes; any other backslash was put in
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\"), F.lit(""))), "\\")


def format_chat(df: DataFrame, turns: str = "turns", learn: Sequence[str] = ("assistant",)) -> DataFrame:
    """``df`` with ``formatted`` and ``loss_spans`` of its column ``turns``."""
    blocks = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(TURN), _escape(t["role"], (END, TURN, HEAD)), F.lit(HEAD)).alias("head"),
        _escape(t["text"], (END, TURN)).alias("text"), t["role"].isin(*learn).alias("learn")))
    df = df.withColumn("blocks_", blocks)
    span = "array<struct<start:long,end:long>>"

    def add(acc: Column, b: Column) -> Column:
        start = acc["at"] + F.length(b["head"])
        end = start + F.length(b["text"])
        own = F.when(b["learn"], F.struct(start.cast("long").alias("start"), end.cast("long").alias("end")))
        return F.struct((end + len(_CLOSE)).cast("long").alias("at"),
                        F.concat(acc["spans"], F.array(own)).alias("spans"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(span).alias("spans"))
    joined = F.array_join(F.transform("blocks_", lambda b: F.concat(b["head"], b["text"], F.lit(_CLOSE))), "")
    return df.withColumns({"formatted": joined,
                           "loss_spans": F.aggregate("blocks_", zero, add, lambda acc: acc["spans"])}).drop("blocks_")


def read_back(df: DataFrame) -> DataFrame:
    """``df`` with ``read_turns`` and ``loss_text`` read from its ``formatted`` and ``loss_spans``."""
    pieces = F.split("formatted", _CLOSE, -1)
    df = df.withColumn("pieces_", F.slice(pieces, F.lit(1), F.size(pieces) - 1))

    def turn(p: Column) -> Column:
        role = F.substring_index(F.substr(p, F.lit(len(TURN) + 1)), HEAD, 1)
        text = F.substr(p, F.length(role) + F.lit(len(TURN) + len(HEAD) + 1))
        return F.struct(_unescape(role).alias("role"), _unescape(text).alias("text"))

    def cut(acc: Column, x: Column) -> Column:
        span = x["loss_spans"]
        own = F.substr(x["pieces_"], (span["start"] - acc["at"] + 1).cast("int"), (span["end"] - span["start"]).cast("int"))
        return F.struct((acc["at"] + F.length(x["pieces_"]) + len(_CLOSE)).cast("long").alias("at"),
                        F.concat(acc["texts"], F.array(F.coalesce(own, F.lit("")))).alias("texts"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("texts"))
    texts = F.aggregate(F.arrays_zip("pieces_", "loss_spans"), zero, cut, lambda acc: acc["texts"])
    return df.withColumns({
        "read_turns": F.transform("pieces_", turn),
        "loss_text": F.array_join(F.transform(texts, _unescape), "")}).drop("pieces_")


def conversation_records(rows: DataFrame) -> DataFrame:
    """``(conv_id, record)``: each conversation of a ``conv_id, turn, role, text`` table in the layout that suits it.

    Turns are ordered by turn, then role and text.  One question and answer, with or without a system turn, becomes a
    prompt record; odd ids with the three usual roles only become a from/value list; all others a message list.
    """
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content")))),
        lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    whole = rows.groupBy("conv_id").agg(ordered.alias("messages"))
    roles = F.transform("messages", lambda m: m["role"])
    pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    triple = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    usual = F.forall("messages", lambda m: m["role"].isin("system", "user", "assistant"))
    share = ~pair & ~triple & usual & (F.pmod("conv_id", F.lit(2)) == 1)
    alias = {"user": "human", "assistant": "gpt"}

    def shared(m: Column) -> Column:
        return F.struct(F.coalesce(*[F.when(m["role"] == a, F.lit(b)) for a, b in alias.items()], m["role"]).alias("from"),
                        m["content"].alias("value"))

    def text(i: int) -> Column:
        return F.get(F.col("messages"), F.lit(i))["content"]

    return whole.select("conv_id", F.struct(
        F.when(triple, text(0)).alias("system"),
        F.when(pair, text(0)).when(triple, text(1)).alias("prompt"),
        F.when(pair, text(1)).when(triple, text(2)).alias("completion"),
        F.when(share, F.transform("messages", shared)).alias("conversations"),
        F.when(~pair & ~triple & ~F.coalesce(share, F.lit(False)), F.col("messages")).alias("messages")).alias("record"))


def chat_digest(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digest columns of formatted conversations, all read back from ``formatted`` and ``loss_spans``."""
    lines = F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back(df).select(
        id_col, F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def chat_sql(extra: str) -> str:
    """DuckDB SQL of the digest of all ``conversations`` plus the rows of ``extra``."""
    def esc(x: str, controls: Sequence[str]) -> str:
        x = f"replace({x}, '\\', '\\\\')"
        for c in controls:
            a, b = c.replace("\n", "' || chr(10) || '"), (c[0] + "\\" + c[1:]).replace("\n", "' || chr(10) || '")
            x = f"replace({x}, '{a}', '{b}')"
        return x

    size = f"{len(TURN) + len(HEAD) + len(_CLOSE)} + length({esc('role', (END, TURN, HEAD))}) + length({esc('text', (END, TURN))})"
    learn = "role = 'assistant'"
    return f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
        SELECT conv_id, turn, role, text FROM conversations UNION ALL {extra}))
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (WHERE {learn}), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE {learn}), '')) AS loss_sha256,
        sum({size})::BIGINT AS formatted_chars
    FROM t GROUP BY conv_id"""

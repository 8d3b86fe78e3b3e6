"""Chat formatting with schema fingerprints, in built-in expressions only.

Records are JSON of any layout. The nested field paths of a record (its
variant schema without the value types) are hashed; the fingerprint selects
a declarative mapping that turns the layout into canonical turns (role,
text). Turns are written with a template whose control strings are escaped
inside texts, so the formatted text can be read back exactly, and the loss
mask is kept as code point ranges of it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "array<struct<role:string,text:string>>"
OPEN, CLOSE = "### ", "</turn>"
FIELD = r"try_variant_get\(v, '\$\.(\w+)', '([^']*)'\)"
LONG = 1 << 21  # characters from which a record may exceed what a variant or its parser holds
# role names of the shared layout -> canonical
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """paths: nested field paths, ``[]`` for array elements; turns: SQL over the variant ``v``."""
    name: str
    paths: tuple[str, ...]
    turns: str


def _pair(user: str, answer: str, system: str | None = None) -> str:
    first = f"struct('system' as role, {system} as text), " if system else ""
    return f"array({first}struct('user' as role, {user} as text), struct('assistant' as role, {answer} as text))"


def _get(path: str) -> str:
    return f"coalesce(try_variant_get(v, '$.{path}', 'string'), '')"


def _messages(field: str, role: str, text: str, names: dict[str, str] | None = None) -> str:
    """``names`` renames roles; others stay as they are."""
    said = f"m.{role}"
    if names:
        known = ", ".join(f"'{a}', '{b}'" for a, b in names.items())
        said = f"coalesce(try_element_at(map({known}), m.{role}), m.{role})"
    return (f"transform(try_variant_get(v, '$.{field}', 'array<struct<{role}:string,{text}:string>>'), "
            f"m -> struct({said} as role, coalesce(m.{text}, '') as text))")


_alpaca = f"concat({_get('instruction')}, if({_get('input')} = '', '', concat('\\n\\n', {_get('input')})))"
LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].content"), _messages("messages", "role", "content")),
    Layout("shared", ("conversations[].from", "conversations[].value"), _messages("conversations", "from", "value", ROLES)),
    Layout("prompt", ("prompt", "response"), _pair(_get("prompt"), _get("response"))),
    Layout("completion", ("prompt", "completion"), _pair(_get("prompt"), _get("completion"))),
    Layout("question", ("question", "answer"), _pair(_get("question"), _get("answer"))),
    Layout("system prompt", ("system", "prompt", "response"), _pair(_get("prompt"), _get("response"), _get("system"))),
    Layout("instruction", ("instruction", "output"), _pair(_get("instruction"), _get("output"))),
    Layout("instruction input", ("instruction", "input", "output"), _pair(_alpaca, _get("output"))),
)


def skeleton(paths: tuple[str, ...]) -> str:
    """The variant schema of nested field paths, without value types."""
    tree: dict = {}
    for path in paths:
        at = tree
        for part in path.split("."):
            at = at.setdefault(part, {})

    def write(node: dict) -> str:
        if not node:
            return "_"
        rows = []
        for name in sorted(node):
            inner = write(node[name])
            rows.append(f"{name.removesuffix('[]')}: ARRAY<{inner}>" if name.endswith("[]") else f"{name}: {inner}")
        return f"OBJECT<{', '.join(rows)}>"
    return write(tree)


def fingerprint(variant: Column) -> Column:
    """Hash of a record's nested field paths; value types (null among them) don't matter."""
    paths = F.regexp_replace(F.schema_of_variant(variant), r"(?<=[:<] ?)(?!OBJECT<|ARRAY<)[A-Z]+(\([0-9, ]+\))?(?=[,>]|$)", "_")
    return F.xxhash64(paths)


def outline(record: Column) -> Column:
    """The record with empty texts and each run of equal array elements once: it has the same nested field paths."""
    body = r'[^"\\]*+(?:\\[\s\S][^"\\]*+)*+'
    bare = F.regexp_replace(record, rf'("{body}"\s*+:)|("){body}(")', "$1$2$3")
    return F.regexp_replace(bare, r"(\{[^{}]*+\})(?:\s*+,\s*+\1)++", "$1")


def _unparsed(x: Layout, record: str) -> str:
    """The layout's turns read from the JSON text, without a variant, which bounds texts and records; null if it is malformed."""
    fields = dict(re.findall(FIELD, x.turns))
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in {**fields, "__bad": "string"}.items())
    options = f"map('maxStringLen', '{(1 << 31) - 1}', 'columnNameOfCorruptRecord', '__bad')"
    turns = re.sub(FIELD, r"w.`\1`", x.turns)
    return f"transform(array(from_json(`{record}`, '{ddl}', {options})), w -> if(w.__bad is null, cast({turns} as {TURN}), null))[0]"


def _escape(c: Column) -> Column:
    for a, b in (("\\", "\\\\"), (OPEN, "\\h"), (CLOSE, "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _unescape(c: Column) -> Column:
    def part(x: Column) -> Column:
        for a, b in (("\\h", OPEN), ("\\t", CLOSE), ("\\n", "\n")):
            x = F.replace(x, F.lit(a), F.lit(b))
        return x
    return F.array_join(F.transform(F.split(c, r"\\\\", -1), part), "\\")


def canonical_turns(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Add ``layout`` (name, or null if no mapping fits) and ``turns`` (array of role, text).

    ``record`` is a JSON string. Null, malformed and unknown layouts get null
    ``layout`` and no turns; null texts are empty; null roles are the empty
    role. Roles keep their names, but for the ``ROLES`` of the shared layout. Records and texts of any length that a column holds are read. Other columns pass through (``layout`` and ``turns`` are replaced).
    """
    v = records.withColumn("v", F.try_parse_json(F.col(record)))
    long = F.col("v").isNull() & (F.length(record) >= LONG)
    v = v.withColumn("__long", long).withColumn("__print", fingerprint(
        F.when(F.col("__long"), F.try_parse_json(outline(F.col(record)))).otherwise(F.col("v"))))
    name, turns = F.lit(None).cast("string"), F.expr(f"cast(array() as {TURN})")
    for x in reversed(layouts):
        same = F.col("__print") == F.xxhash64(F.lit(skeleton(x.paths)))
        name = F.when(same, F.lit(x.name)).otherwise(name)
        turns = (F.when(same & F.col("__long"), F.expr(_unparsed(x, record))).when(same, F.expr(x.turns).cast(TURN))
                 .otherwise(turns))
    v = v.withColumn("__turns", turns)
    wrong = F.col("__long") & F.col("__turns").isNull()
    name, turns = F.when(~wrong, name), F.when(wrong, F.expr(f"cast(array() as {TURN})")).otherwise(F.col("__turns"))

    def canonical(t: Column) -> Column:
        return F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))
    return v.withColumn("layout", name).withColumn("turns", F.transform(turns, canonical)).drop("v", "__long", "__print", "__turns")


def format_chat(turned: DataFrame, learn: str = "assistant") -> DataFrame:
    """Add ``formatted`` and ``loss`` (array of [start, end) code point ranges: the escaped texts of role ``learn``).

    A turn is ``### role``, a line break, the text and ``</turn>`` with a line
    break; control strings and backslashes inside are escaped. No turns give
    an empty text.
    """
    def parts(t: Column) -> Column:
        head = F.concat(F.lit(OPEN), F.replace(_escape(t["role"]), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
        return F.struct(head.alias("head"), _escape(t["text"]).alias("body"), (t["role"] == learn).alias("on"))

    df = turned.withColumn("__p", F.transform("turns", parts))
    df = df.withColumn("formatted", F.array_join(
        F.transform("__p", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE + "\n"))), ""))
    sizes = F.transform("__p", lambda p: F.struct(F.length(p["head"]).cast("long").alias("h"), F.length(p["body"]).cast("long").alias("b"),
                                                  p["on"].alias("on")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        a = acc["at"] + s["h"]
        span = F.array(F.struct(a.alias("start"), (a + s["b"]).alias("end")))
        return F.struct((a + s["b"] + len(CLOSE) + 1).alias("at"),
                        F.when(s["on"], F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))
    return df.withColumn("loss", F.aggregate(sizes, start, step, lambda a: a["out"])).drop("__p")


def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``read`` (array of role, text) and ``learned`` (the texts under the loss mask, joined), both from the formatted text."""
    pieces = F.split(F.col("formatted"), CLOSE + "\n", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(p: Column) -> Column:
        at = F.instr(p, "\n")
        role = F.substr(p, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        return F.struct(_unescape(role).alias("role"), _unescape(F.substr(p, at + 1)).alias("text"))

    def under(s: Column) -> Column:
        return _unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return (formatted.withColumn("read", F.transform(pieces, turn))
            .withColumn("learned", F.array_join(F.transform("loss", under), "")))


def records_of_rows(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """One JSON record per conversation from rows (conv_id, turn, role, text), in the layout its shape suggests.

    Turns are ordered by ``turn`` (nulls first), equal ones by role and text;
    a user and an assistant turn become a prompt record, with a system turn
    before them a system prompt record, everything else messages. Rows with a
    null key are one conversation; null texts are empty.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    one = rows.groupBy(key).agg(F.sort_array(F.collect_list(turn)).alias("m"))  # one conversation
    names = F.array_join(F.transform("m", lambda x: F.replace(x["role"], F.lit(","), F.lit("?"))), ",")
    at = [F.col("m")[i]["content"] for i in range(3)]
    message = F.struct(F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))
    record = (F.when(names == "user,assistant", F.to_json(F.struct(at[0].alias("prompt"), at[1].alias("response"))))
              .when(names == "system,user,assistant",
                    F.to_json(F.struct(at[0].alias("system"), at[1].alias("prompt"), at[2].alias("response"))))
              .otherwise(F.to_json(message)))
    return one.select(key, record.alias("record"))

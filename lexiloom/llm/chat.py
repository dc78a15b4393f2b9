"""Chat formatting: layouts by schema fingerprint, canonical turns, one template with a loss mask.

Records come in many layouts. A layout is declared by the nested field paths it needs and an expression that turns a record
into canonical turns (role, text). Field paths are hashed, those of a table's schema or, record by record, those that a JSON
record has; of the layouts all of whose hashes occur, the one with most paths is applied, the first of equal ones. In tables
that have the fields of several record layouts each row is told by the fields that are not null in it. Turns in JSON lists may
name their fields by either list layout. The hash of all paths of a record is its fingerprint: ``layouts_found`` counts records
by fingerprint and tells which have no layout.

The template writes each turn as ``<|turn|>role``, a line break, the text and ``<|end|>``. Backslashes in roles and texts
are doubled, and a backslash is put into every control string (also those of other common templates), so texts can neither
end a turn nor begin one, and ``unescaped`` gives them back exactly. The loss mask covers the texts of assistants.

Null roles and texts count as empty. Turns are ordered by their number (null first), then role and text, so repeated rows
stay and ties have an order. Rows without a conversation id form one conversation. JSON records of no known layout have a null
layout and no turns; a table of no known layout is an error. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

TURN, END = "<|turn|>", "<|end|>"
#: Strings that no formatted text may contain.
CONTROLS = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ASSISTANT = ("assistant",)
#: Names of roles in message layouts; other names stay.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Paths of all fields without further fields, lower-cased; ``[]`` stands for the elements of an array."""
    if isinstance(kind, T.StructType):
        return [path for f in kind for path in field_paths(f.dataType, f"{at}.{f.name.lower()}" if at else f.name.lower())]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def path_hashes(paths: list[str]) -> frozenset[int]:
    return frozenset(xxhash.xxh3_64_intdigest(path) for path in paths)


def _turn(role: Column | str, text: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    empty = F.lit("")
    return F.struct(F.coalesce(role, empty).alias("role"), F.coalesce(text, empty).alias("text"))


def _named(role: Column) -> Column:
    name = F.lower(role)
    found = role
    for given, wanted in ROLE_NAMES.items():
        found = F.when(name == given, F.lit(wanted)).otherwise(found)
    return found


def _messages(field: str, role: str, text: str) -> Callable[[], Column]:
    return lambda: F.transform(F.col(field), lambda m: _turn(_named(m[role]), m[text]))


def _pair(prompt: str, answer: str) -> Callable[[], Column]:
    return lambda: F.array(_turn("user", F.col(prompt)), _turn("assistant", F.col(answer)))


def _instruction() -> Column:
    given = F.coalesce(F.col("input"), F.lit(""))
    asked = F.when(given == "", F.col("instruction")).otherwise(F.concat_ws("\n\n", "instruction", "input"))
    return F.array(_turn("user", asked), _turn("assistant", F.col("output")))


@dataclass(frozen=True)
class Layout:
    """``paths`` a record must have, and its turns; rows of ``by_turn`` layouts are single turns of a conversation."""

    name: str
    paths: tuple[str, ...]
    turns: Callable[[], Column] | None

    @property
    def by_turn(self) -> bool:
        return self.turns is None


LAYOUTS = (
    Layout("turn rows", ("conv_id", "turn", "role", "text"), None),
    Layout("messages", ("messages[].role", "messages[].content"), _messages("messages", "role", "content")),
    Layout("exchanges", ("conversations[].from", "conversations[].value"), _messages("conversations", "from", "value")),
    Layout("instruction", ("instruction", "input", "output"), _instruction),
    Layout("prompt and response", ("prompt", "response"), _pair("prompt", "response")),
    Layout("prompt and completion", ("prompt", "completion"), _pair("prompt", "completion")),
    Layout("question and answer", ("question", "answer"), _pair("question", "answer")),
)
#: All fields of the record layouts, to read JSON records with.
JSON_SCHEMA = (
    "messages array<struct<role string, content string, `from` string, value string>>, "
    "conversations array<struct<role string, content string, `from` string, value string>>, "
    "instruction string, input string, output string, prompt string, response string, completion string, "
    "question string, answer string"
)


def layout_of(schema: T.StructType) -> Layout | None:
    """The layout whose path hashes all occur in the schema; the one with most paths, the first of equal ones."""
    known = path_hashes(field_paths(schema))
    fitting = [layout for layout in LAYOUTS if path_hashes(list(layout.paths)) <= known]
    return max(fitting, key=lambda layout: len(layout.paths), default=None)


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def json_paths(record: Column) -> Column:
    """Paths of a JSON object: fields that are not null, ``name[]`` for lists, ``name[].field`` and ``name.field`` for what
    the elements of a list of objects, or an object, have. Empty for anything else."""
    fields = F.map_entries(F.coalesce(F.from_json(record, "map<string,string>"), F.expr("map()").cast("map<string,string>")))
    inner = lambda value, kind: F.from_json(value, kind)

    def paths(field: Column) -> Column:
        name, value = field["key"], field["value"]
        elements = F.filter(inner(value, "array<map<string,string>>"), lambda x: x.isNotNull())
        names = F.array_distinct(F.flatten(F.transform(elements, F.map_keys)))
        of_list = F.concat(F.array(F.concat(name, F.lit("[]"))), F.coalesce(F.transform(names, lambda x: F.concat(name, F.lit("[]."), x)), _strings([])))
        of_object = F.coalesce(F.transform(F.map_keys(inner(value, "map<string,string>")), lambda x: F.concat(name, F.lit("."), x)), _strings([]))
        return F.when(value.startswith("["), of_list).when(value.startswith("{"), of_object).otherwise(F.array(name))

    present = F.filter(fields, lambda field: field["value"].isNotNull())
    return F.array_sort(F.array_distinct(F.flatten(F.transform(present, paths))))


def _row_paths(schema: T.StructType) -> Column:
    """The same for a row of a table, whose schema tells what elements of lists have."""
    found = []
    for field in schema:
        name = field.name
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StructType):
            inside = [f"{name}[].{x.name}".lower() for x in field.dataType.elementType]
            found.append(F.when(F.col(f"`{name}`").isNotNull(), _strings([f"{name}[]".lower()])))
            found.append(F.when(F.size(f"`{name}`") > 0, _strings(inside)))
        else:
            found.append(F.when(F.col(f"`{name}`").isNotNull(), _strings([name.lower()])))
    return F.flatten(F.filter(F.array(*found), lambda x: x.isNotNull()))


def _hashed(paths: Column) -> Column:
    return F.transform(paths, lambda path: F.xxhash64(path))


def fingerprint(paths: Column) -> Column:
    """One number for a set of paths."""
    return F.xxhash64(F.array_join(F.array_sort(paths), "\n"))


def _chosen(hashes: Column, layouts: list[Layout], either_names: bool = False) -> tuple[Column, Column]:
    """(name, turns) of the layout with most paths whose hashes are all among ``hashes``; nulls if there is none."""
    options = []
    for layout in layouts:
        tops = list(dict.fromkeys(path.split("[")[0] for path in layout.paths))
        turns = layout.turns()
        if "[]" in layout.paths[0]:
            top, needed = tops[0], [layout.paths]
            if either_names:
                needed = [tuple(f"{top}[].{name}" for name in names) for names in (("role", "content"), ("from", "value"))]
                turns = F.transform(
                    top, lambda m: _turn(_named(F.coalesce(m["role"], m["from"])), F.coalesce(m["content"], m["value"]))
                )
            options += [(len(paths), paths, F.lit(True), layout.name, turns) for paths in needed]
            options.append((1, (f"{top}[]",), F.size(top) == 0, layout.name, turns))
        else:
            for needed in dict.fromkeys((layout.paths, tuple(path for path in layout.paths if path != "input"))):
                options.append((len(needed), needed, F.lit(True), layout.name, turns))
    name, chosen = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for _, needed, guard, layout_name, turns in reversed(sorted(options, key=lambda option: -option[0])):
        fits = (F.size(F.array_except(F.array(*[F.xxhash64(F.lit(path)) for path in needed]), hashes)) == 0) & guard
        fits = F.coalesce(fits, F.lit(False))
        name = F.when(fits, F.lit(layout_name)).otherwise(name)
        chosen = F.when(fits, turns).otherwise(chosen)
    return name, chosen


def canonical(records: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """(conv_id, turns) of a table in any known layout; its layouts are found from the schema."""
    layout = layout_of(records.schema)
    if layout is None:
        raise ValueError(f"no known layout has the fields {', '.join(field_paths(records.schema))}")
    if not layout.by_turn:
        known = path_hashes(field_paths(records.schema))
        fitting = [one for one in LAYOUTS if not one.by_turn and path_hashes(list(one.paths)) <= known]
        turns = F.coalesce(layout.turns(), F.array())
        if len(fitting) > 1:
            turns = F.coalesce(_chosen(_hashed(_row_paths(records.schema)), fitting)[1], turns)
        return records.select(F.col(id_column).alias("conv_id"), turns.alias("turns"))
    one = F.struct("turn", _turn(F.col("role"), F.col("text")).alias("said"))
    grouped = records.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("rows"))
    return grouped.select("conv_id", F.col("rows.said").alias("turns"))


TURNS = "array<struct<role:string,text:string>>"


def _read_json(records: DataFrame, id_column: str, json_column: str) -> DataFrame:
    """(conv_id, _paths, _hashes, and the fields of all record layouts) of JSON records."""
    parsed = records.select(
        F.col(id_column).alias("conv_id"), json_paths(F.col(json_column)).alias("_paths"), F.from_json(json_column, JSON_SCHEMA).alias("_r")
    )
    return parsed.select("conv_id", "_paths", _hashed(F.col("_paths")).alias("_hashes"), "_r.*")


def _record_layouts() -> list[Layout]:
    return [one for one in LAYOUTS if not one.by_turn]


def canonical_json(records: DataFrame, id_column: str, json_column: str) -> DataFrame:
    """(conv_id, layout, turns, fingerprint) of JSON records of mixed layouts, each mapped by the hashes of its own paths."""
    layout, turns = _chosen(F.col("_hashes"), _record_layouts(), either_names=True)
    turns = F.coalesce(turns, F.expr(f"cast(array() as {TURNS})"))
    return _read_json(records, id_column, json_column).select(
        "conv_id", layout.alias("layout"), turns.alias("turns"), fingerprint(F.col("_paths")).alias("fingerprint")
    )


def layouts_found(records: DataFrame, json_column: str) -> DataFrame:
    """(fingerprint, paths, layout, n_records): the kinds of JSON records there are; a null layout tells of lost records."""
    read = _read_json(records.withColumn("_one", F.lit(1)), "_one", json_column)
    layout, _ = _chosen(F.col("_hashes"), _record_layouts(), either_names=True)
    kinds = read.select(fingerprint(F.col("_paths")).alias("fingerprint"), "_paths", layout.alias("layout"))
    return kinds.groupBy("fingerprint", "layout").agg(F.first("_paths").alias("paths"), F.count(F.lit(1)).alias("n_records")).select(
        "fingerprint", "paths", "layout", "n_records"
    )


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        text = F.replace(text, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def with_format(conversations: DataFrame, roles: tuple[str, ...] = ASSISTANT) -> DataFrame:
    """Adds formatted and loss_mask: spans (start, end; code points, end exclusive) of the texts that are learned."""
    safe = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(TURN), F.replace(escaped(t["role"]), F.lit("\n"), F.lit("\\\n")), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
            t["role"].isin(*roles).alias("learned"),
        ),
    )
    joined = F.array_join(F.transform("_safe", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")

    def add(done: Column, t: Column) -> Column:
        start = done["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        span = F.struct(start.alias("start"), end.alias("end"))
        spans = F.when(t["learned"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct((end + len(END)).alias("at"), spans.alias("spans"))

    none = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))
    return (
        conversations.withColumn("_safe", safe)
        .withColumn("formatted", joined)
        .withColumn("loss_mask", F.aggregate("_safe", none, add)["spans"])
        .drop("_safe")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds read (turns found in formatted) and loss_text (what is under loss_mask, unescaped)."""
    pieces = F.split("formatted", F.lit("<\\|end\\|>"), -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    heads = F.transform(
        pieces, lambda p: F.struct(p.alias("piece"), F.regexp_extract(p, r"(?s)^<\|turn\|>((?:[^\\\n]++|\\.)*+)\n", 1).alias("role"))
    )
    turns = F.transform(
        heads,
        lambda h: F.struct(
            unescaped(h["role"]).alias("role"),
            unescaped(F.substr(h["piece"], F.length(h["role"]) + len(TURN) + 2)).alias("text"),
        ),
    )
    learned = F.transform(
        "loss_mask", lambda s: unescaped(F.substr("formatted", s["start"] + 1, s["end"] - s["start"]))
    )
    return formatted.withColumn("read", turns).withColumn("loss_text", F.array_join(learned, ""))


def report(conversations: DataFrame) -> DataFrame:
    """Digests of what a reader of the formatted conversations finds."""
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(with_format(conversations)).select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


PROBE = "</s>[INST] ok [/INST]"


def _sql_escaped(column: str) -> str:
    sql = rf"replace({column}, '\', '\\')"
    for control in CONTROLS:
        sql = f"replace({sql}, '{control}', '{control[0]}\\{control[1:]}')"
    return sql


ORACLE = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
said AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum({len(TURN) + len(END) + 1} + length(replace({_sql_escaped("role")}, chr(10), '\\' || chr(10)))
             + length({_sql_escaped("text")})) AS formatted
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted AS BIGINT) AS formatted_chars
FROM said
"""

"""Chat records of many layouts as one reversible training format.

A record is a JSON object. Its fingerprint is the hash of the nested field paths it has, out of
the paths that some layout names, in a fixed order; it selects the layout, and the layout says
which fields become which turns. Other fields do not matter.

Turns are written as ``<|turn|>role newline text <|end|>``. A backslash is put after every
backslash, after the first character of every control string of this and other chat formats,
and after newlines of roles, so no text can end a turn or pose as one; taking the character
after each backslash restores the text. Loss is borne by the texts of assistant turns, one flag
per turn.

Defined results: null roles and texts are empty; null, unreadable or unknown records have no
turns, a null layout and an empty text, and only unknown ones have a fingerprint; texts of any length
are read whole; records without turns have an empty text; repeated
records are formatted each; extra columns pass through. A formatted record is one string, so a
single conversation must fit into a row.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.llm.common import fresh, let

TURN, END = "<|turn|>", "<|end|>"
#: Strings that open, close or mark something in a chat format.
CONTROLS = ("<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
_MARKED = r"\\|<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])"
ASSISTANT = "assistant"
#: Without it texts of more than 20 million characters would not be read.
_ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}
SAME_ROLE = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Fixed:
    """Top-level fields that become one turn each; fields of one turn are joined by a blank line."""

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...]
    optional: tuple[str, ...] = ()

    def paths(self) -> list[str]:
        return [field for _, fields in self.turns for field in fields]


@dataclass(frozen=True)
class Listed:
    """An array of objects, one turn each."""

    name: str
    field: str
    role: str
    text: str
    optional: tuple[str, ...] = ()

    def paths(self) -> list[str]:
        return [self.field, f"{self.field}[].{self.role}", f"{self.field}[].{self.text}"]


LAYOUTS: tuple[Fixed | Listed, ...] = (
    Listed("messages", "messages", "role", "content", ("messages[].role", "messages[].content")),
    Listed("conversations", "conversations", "from", "value", ("conversations[].from", "conversations[].value")),
    Listed("dialog", "dialog", "speaker", "text", ("dialog[].speaker", "dialog[].text")),
    Fixed("instruction", (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))), ("system", "input")),
    Fixed("prompt_response", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), ("system",)),
    Fixed("prompt_completion", (("user", ("prompt",)), ("assistant", ("completion",)))),
    Fixed("question_answer", (("user", ("question",)), ("assistant", ("answer",)))),
)


def _variants(layout: Fixed | Listed) -> list[tuple[str, ...]]:
    """The sets of paths a record of the layout may have."""
    needed = [p for p in layout.paths() if p not in layout.optional]
    return [
        tuple(p for p in layout.paths() if p in needed or p in chosen)
        for n in range(len(layout.optional) + 1)
        for chosen in combinations(layout.optional, n)
    ]


def _schema(layouts: tuple[Fixed | Listed, ...]) -> str:
    """All fields that some layout names, as strings; a JSON value that is no string keeps its JSON."""
    fields: dict[str, str] = {}
    for layout in layouts:
        if isinstance(layout, Listed):
            fields[layout.field] = f"array<struct<`{layout.role}`: string, `{layout.text}`: string>>"
        else:
            fields |= {path: "string" for path in layout.paths()}
    return "struct<" + ", ".join(f"`{name}`: {kind}" for name, kind in fields.items()) + ">"


def _known(layouts: tuple[Fixed | Listed, ...]) -> list[str]:
    return list(dict.fromkeys(path for layout in layouts for path in layout.paths()))


def _present(record: Column, keys: Column, layouts: tuple[Fixed | Listed, ...]) -> Column:
    found = []
    for path in _known(layouts):
        field, _, inner = path.partition("[].")
        here = F.array_contains(keys, field)
        if inner:
            here &= F.exists(record[field], lambda x: x[inner].isNotNull())
        found.append(F.when(here, F.lit(path)))
    return F.array_compact(F.array(*found))


def _fingerprint_of(paths: tuple[str, ...], known: list[str]) -> Column:
    return F.xxhash64(F.lit("\n".join(p for p in known if p in paths)))


def _turns(record: Column, layout: Fixed | Listed) -> Column:
    empty = F.lit("")
    if isinstance(layout, Listed):
        roles = F.create_map(*(F.lit(x) for pair in SAME_ROLE.items() for x in pair))

        def turn(x: Column) -> Column:
            role = F.coalesce(x[layout.role], empty)
            same = role if layout.name == "messages" else F.coalesce(F.try_element_at(roles, role), role)
            return F.struct(same.alias("role"), F.coalesce(x[layout.text], empty).alias("text"))

        return F.transform(F.coalesce(record[layout.field], F.array()), turn)
    made = []
    for role, fields in layout.turns:
        text = F.array_join(F.filter(F.array(*(record[f] for f in fields)), lambda x: x != ""), "\n\n")
        turn = F.struct(F.lit(role).alias("role"), text.alias("text"))
        optional = all(f in layout.optional for f in fields)
        made.append(F.when(record[fields[0]].isNotNull(), turn) if optional else turn)
    return F.filter(F.array(*made), lambda x: x.isNotNull())


def canonical(records: DataFrame, column: str = "record", layouts: tuple[Fixed | Listed, ...] = LAYOUTS) -> DataFrame:
    """``records`` with ``fingerprint``, ``layout`` and ``turns`` (array of role and text) appended."""
    parsed, keys = fresh(records, "parsed"), fresh(records, "parsed_keys")
    read = records.select(
        "*", F.from_json(column, _schema(layouts), _ANY_LENGTH).alias(parsed), F.json_object_keys(column).alias(keys)
    )
    known = _known(layouts)
    mark = F.xxhash64(F.array_join(_present(F.col(parsed), F.col(keys), layouts), "\n"))
    marked = read.select("*", F.when(F.col(keys).isNotNull(), mark).alias("fingerprint"))
    number, turns = F.lit(None).cast("string"), F.array().cast("array<struct<role: string, text: string>>")
    for layout in layouts:
        fits = F.col("fingerprint").isin(*(_fingerprint_of(v, known) for v in _variants(layout)))
        number = F.when(fits, F.lit(layout.name)).otherwise(number)
        turns = F.when(fits, _turns(F.col(parsed), layout)).otherwise(turns)
    return marked.select(*records.columns, "fingerprint", number.alias("layout"), turns.alias("turns"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _MARKED, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """``formatted`` and ``loss`` (one flag per turn) in place of ``turns``."""
    written = F.transform(
        "turns",
        lambda x: F.concat(
            F.lit(TURN),
            F.regexp_replace(escape(x["role"]), "\n", "\\\\\n"),
            F.lit("\n"),
            escape(x["text"]),
            F.lit(END),
        ),
    )
    kept = [c for c in turns.columns if c != "turns"]
    return turns.select(
        *kept,
        F.array_join(written, "").alias("formatted"),
        F.transform("turns", lambda x: x["role"] == ASSISTANT).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``turns`` in place of ``formatted``, from the marks alone."""

    def turn(part: Column) -> Column:
        body = F.left(part, F.char_length(part) - len(END))
        head = F.regexp_extract(body, r"^((?:[^\\\n]++|\\[\s\S])*+)\n", 1)
        text = F.substring(body, F.char_length(head) + 2, F.char_length(body))
        return F.struct(unescape(head).alias("role"), unescape(text).alias("text"))

    parts = F.split("formatted", r"<\|turn\|>")
    kept = [c for c in formatted.columns if c != "formatted"]
    return formatted.select(*kept, F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn).alias("turns"))


def records_of_rows(rows: DataFrame) -> DataFrame:
    """One ``record`` per ``conv_id`` from rows of ``conv_id``, ``turn``, ``role`` and ``text``.

    Turns are ordered by number, then role, then text; null numbers come first.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    messages = F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return listed.select("conv_id", F.to_json(F.struct(messages.alias("messages"))).alias("record"))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what can be read back from its formatted text and its loss flags."""
    back = read_back(formatted.select("conv_id", "loss", F.char_length("formatted").cast("long").alias("formatted_chars"), "formatted"))
    told = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter(F.arrays_zip("turns", "loss"), lambda x: x["loss"]), lambda x: x["turns"]["text"]), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        let(learned, lambda x: F.struct(F.char_length(x).cast("long").alias("chars"), F.sha2(x, 256).alias("hash"))).alias("loss"),
        "formatted_chars",
    ).select("conv_id", "n_turns", "turns_sha256", F.col("loss.chars").alias("loss_chars"), F.col("loss.hash").alias("loss_sha256"), "formatted_chars")

"""Chat formatting: templates compiled to closures that render conversations and mark what is to be learned.

A template is text with `{{ expression }}`, `{% if %}`/`{% elif %}`/`{% else %}`/`{% endif %}`, one
`{% for message in messages %}` that is not inside another tag, `{% generation %}` around what a model should say,
and `{# remarks #}`.  Expressions know literals, `message.role`, `message.text`, `loop.index0`, `loop.first`,
`loop.last`, comparison, `and`/`or`/`not`, `a if b else c`, `+` for joining and `|` for filters, which binds less
tightly than `+`.  Anything else does not compile, so a template can reach nothing of the process it runs in.

Rows are sorted by conversation and turn in ranges, so that a very long conversation is rendered by several tasks.
"""

from __future__ import annotations

import ast
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from larder.llm.common import cut, map_stream, new_folder, shuffles_removed, table

HEAD, TAIL = "### ", "</turn>\n"
TEMPLATE = (
    "{% for message in messages %}" + HEAD + "{{ message.role | name }}: "
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}" + TAIL + "{% endfor %}"
)
PART = 1 << 20  # code points of a row of the output; a longer text is a row of its own
_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_AGAIN = re.compile("(?<=#)#")
_ESCAPED = re.compile(r"\\(.)", re.S)


def escaped(text: str) -> str:
    """No `</` and no two `#` in a row are left, so neither mark of a turn can occur; a backslash hides a character."""
    text = text.replace("\\", "\\\\").replace("</", "<\\/")
    return _AGAIN.sub(r"\\#", text) if "##" in text else text


def escaped_name(text: str) -> str:
    return escaped(text).replace(":", "\\:")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escaped, "name": escaped_name, "upper": str.upper, "lower": str.lower, "trim": str.strip, "title": str.title,
}
FIELDS = {"message": ("role", "text"), "loop": ("index0", "first", "last")}


class TemplateError(ValueError):
    pass


# the syntax tree


@dataclass
class Text:
    text: str


@dataclass
class Output:
    expression: ast.expr


@dataclass
class If:
    test: ast.expr
    then: list
    other: list


@dataclass
class Loop:
    body: list


@dataclass
class Generation:
    body: list


def _expression(source: str) -> ast.expr:
    try:
        return ast.parse(source.strip(), mode="eval").body
    except (SyntaxError, ValueError, RecursionError) as e:
        raise TemplateError(f"not an expression: {source.strip()}") from e


def parsed(template: str) -> list:
    """The syntax tree of a template."""
    tokens: list[tuple[str, str]] = []
    at = 0
    for m in _TAG.finditer(template):
        tokens.append(("text", template[at : m.start()]))
        if m[1] is not None:
            tokens.append(("output", m[1]))
        elif m[2] is not None:
            tokens.append(("tag", m[2].strip()))
        at = m.end()
    tokens.append(("text", template[at:]))
    tokens.reverse()

    def block(ends: tuple[str, ...], outermost: bool = False) -> tuple[list, str]:
        nodes: list = []
        while tokens:
            kind, value = tokens.pop()
            word = value.split(" ")[0]
            if kind == "text":
                nodes.append(Text(value))
            elif kind == "output":
                nodes.append(Output(_expression(value)))
            elif word in ends:
                return nodes, value
            elif word == "if":
                nodes.append(branch(value[2:]))
            elif value == "generation":
                nodes.append(Generation(block(("endgeneration",))[0]))
            elif outermost and re.fullmatch(r"for\s+message\s+in\s+messages", value):
                nodes.append(Loop(block(("endfor",))[0]))
            else:
                raise TemplateError(f"tag not known here: {value}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return nodes, ""

    def branch(test: str) -> If:
        then, end = block(("elif", "else", "endif"))
        if end.startswith("elif"):
            return If(_expression(test), then, [branch(end[4:])])
        return If(_expression(test), then, block(("endif",))[0] if end == "else" else [])

    nodes, _ = block((), outermost=True)
    if sum(isinstance(n, Loop) for n in nodes) != 1:
        raise TemplateError("a template has one loop over messages")
    return nodes


def _run(value: object) -> str:
    if not isinstance(value, (str, int)) or isinstance(value, bool):
        raise TemplateError(f"not a text: {value!r}")
    return str(value)


def compiled(node: ast.expr, used: set[str]) -> Callable[[dict], object]:
    """A closure for an expression; `used` collects the names that it reads.  Without any it is a constant and is
    computed now."""
    own: set[str] = set()
    made = _closure(node, own)
    used |= own
    if own:
        return made
    value = made({})
    return lambda env: value


def _closure(node: ast.expr, used: set[str]) -> Callable[[dict], object]:
    part = lambda x: compiled(x, used)
    match node:
        case ast.Constant(value=str() | int() | None as value):
            return lambda env: value
        case ast.Name(id="true" | "false" | "none" as name):
            value = {"true": True, "false": False, "none": None}[name]
            return lambda env: value
        case ast.Attribute(value=ast.Name(id=owner), attr=name) if name in FIELDS.get(owner, ()):
            used.add(owner)
            return lambda env: env[owner][name]
        case ast.Compare(left=left, ops=[ast.Eq() | ast.NotEq() as op], comparators=[right]):
            a, b, equal = part(left), part(right), isinstance(op, ast.Eq)
            return lambda env: (a(env) == b(env)) is equal
        case ast.BoolOp(op=op, values=values):
            parts, every = [part(v) for v in values], isinstance(op, ast.And)
            return lambda env: all(p(env) for p in parts) if every else any(p(env) for p in parts)
        case ast.UnaryOp(op=ast.Not(), operand=x):
            inner = part(x)
            return lambda env: not inner(env)
        case ast.BinOp(left=left, op=ast.Add(), right=right):
            a, b = part(left), part(right)
            return lambda env: _run(a(env)) + _run(b(env))
        case ast.BinOp(left=left, op=ast.BitOr(), right=ast.Name(id=name)) if name in FILTERS:
            inner, by = part(left), FILTERS[name]
            return lambda env: by(_run(inner(env)))
        case ast.IfExp(test=test, body=yes, orelse=no):
            t, a, b = part(test), part(yes), part(no)
            return lambda env: a(env) if t(env) else b(env)
    raise TemplateError(f"not allowed: {ast.unparse(node)}")


def folded(nodes: list) -> list:
    """The tree with constant outputs as text, constant branches chosen and neighbouring texts joined."""
    out: list = []
    for node in nodes:
        used: set[str] = set()
        match node:
            case Output(expression):
                value = compiled(expression, used)
                made = [node if used else Text(_run(value({})))]
            case If(test, then, other):
                value = compiled(test, used)
                made = [If(test, folded(then), folded(other))] if used else folded(then if value({}) else other)
            case Loop(body):
                made = [Loop(folded(body))]
            case Generation(body):
                made = [Generation(folded(body))]
            case _:
                made = [node]
        for x in made:
            if isinstance(x, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].text + x.text)
            elif not isinstance(x, Text) or x.text:
                out.append(x)
    return out


@dataclass
class Rendered:
    """What closures write to: texts in a row, and the spans between generation marks, in code points."""

    texts: list[str] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    size: int = 0

    def add(self, text: str) -> None:
        self.texts.append(text)
        self.size += len(text)


def _writer(nodes: list, used: set[str]) -> Callable[[dict, Rendered], None]:
    steps: list[Callable[[dict, Rendered], None]] = []
    for node in nodes:
        match node:
            case Text(text):
                steps.append(lambda env, out, text=text: out.add(text))
            case Output(expression):
                value = compiled(expression, used)
                steps.append(lambda env, out, value=value: out.add(_run(value(env))))
            case If(test, then, other):
                chosen = compiled(test, used), _writer(then, used), _writer(other, used)
                steps.append(lambda env, out, c=chosen: c[1](env, out) if c[0](env) else c[2](env, out))
            case Generation(body):
                steps.append(lambda env, out, body=_writer(body, used): _marked(env, out, body))
            case _:
                raise TemplateError("a loop inside a tag")

    def write(env: dict, out: Rendered) -> None:
        for step in steps:
            step(env, out)

    return write


def _marked(env: dict, out: Rendered, body: Callable[[dict, Rendered], None]) -> None:
    start, known = out.size, len(out.spans)
    body(env, out)
    del out.spans[known:]  # marks inside marks are one
    if out.size > start:
        out.spans.append((start, out.size))


class Template:
    """A compiled template.  `places`: whether output depends on where in its conversation a message stands."""

    def __init__(self, source: str = TEMPLATE):
        nodes = folded(parsed(source))
        at = next(i for i, n in enumerate(nodes) if isinstance(n, Loop))
        outside: set[str] = set()
        inside: set[str] = set()
        self.head, self.tail = _writer(nodes[:at], outside), _writer(nodes[at + 1 :], outside)
        if outside:
            raise TemplateError("message and loop are known inside the loop only")
        self.body = _writer(nodes[at].body, inside)
        self.places = "loop" in inside or len(nodes) > 1

    def render(self, messages: list[tuple[str, str]], first: int = 0, starts: bool = True, ends: bool = True) -> Rendered:
        """Messages (role, text) of a conversation from number `first` on; `starts` and `ends` tell whether they are
        its first and its last ones."""
        out = Rendered()
        if starts:
            self.head({}, out)
        for i, (role, text) in enumerate(messages):
            places = {"index0": first + i, "first": starts and i == 0, "last": ends and i == len(messages) - 1}
            self.body({"message": {"role": role, "text": text}, "loop": places}, out)
        if ends:
            self.tail({}, out)
        return out


def turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a text made by the default template."""
    out = []
    for turn in text.split(TAIL)[:-1]:
        role, _, said = re.match(re.escape(HEAD) + r"((?:[^\\:]|\\.)*)(: )(.*)", turn, re.S).groups()
        out.append((unescaped(role), unescaped(said)))
    return out


def _stream(df: DataFrame, ddl: str, fn: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """`map_stream` by rows; `_size` of a row is its share of a batch."""
    schema = StructType.fromDDL(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        out, size = [], 0
        for row in fn(r for b in batches for r in b.to_pylist()):
            out.append(row)
            size += row.pop("_size", 0)
            if len(out) >= 500 or size > 4 * PART:
                yield {n: [r[n] for r in out] for n in schema.names}
                out, size = [], 0
        if out:
            yield {n: [r[n] for r in out] for n in schema.names}

    return map_stream(df, schema, run)


def _parts(rows: Iterator[dict], limit: int) -> Iterator[dict]:
    """Sorted rows to runs of messages of one conversation.

    `nth`: messages of the conversation before, in this slice.  `alone`: it is the whole conversation for sure, since
    another one stands before and behind it in the slice and it was not cut.
    """
    slice_ = TaskContext.get().partitionId()
    now: dict | None = None
    count, cut_, first = 0, False, True

    def made(alone: bool, done: bool) -> dict:
        return now | {"alone": alone and not cut_ and not first, "done": done, "slice": slice_}

    for row in rows:
        value = {"role": row["role"] or "", "text": row["text"] or ""}
        if now is not None and row["conv_id"] != now["conv_id"]:
            yield made(True, True)
            now, count, cut_, first = None, 0, False, False
        elif now is not None and now["_size"] + len(value["text"]) > limit:
            cut_ = True
            yield made(False, False)
            now = None
        if now is None:
            now = {"conv_id": row["conv_id"], "nth": count, "messages": [], "_size": 0}
        now["messages"].append(value)
        now["_size"] += len(value["text"])
        count += 1
    if now is not None:
        yield made(False, True)


def write(
    conversations: DataFrame, folder: str, template: str = TEMPLATE, conv_id: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text", limit: int = PART,
) -> None:
    """Render every conversation and write rows conv_id, slice, nth, alone, n_turns, text, loss (spans of `text` in
    code points) to Parquet.

    Most conversations are one row; those of more than `limit` code points, or across two ranges of the sort, are
    several, in order of (slice, nth).  Turns ascend (null first), turns of equal number by a hash of role and text;
    null role and text are empty; rows without conv_id are one conversation; repeated rows are turns of their own.
    Other columns are left out.  An empty table writes no rows.
    """
    spark = conversations.sparkSession
    ready = Template(template)
    id_type = conversations.schema[conv_id].dataType.simpleString()
    rows = conversations.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text")
    ).withColumn("tie", F.xxhash64("role", "text"))
    ordered = rows.repartitionByRange("conv_id", "turn", "tie").sortWithinPartitions("conv_id", "turn", "tie", "role", "text")
    head = f"conv_id {id_type}, slice int, nth long, alone boolean"
    parts = _stream(
        ordered.select("conv_id", "role", "text"), f"{head}, done boolean, messages array<struct<role:string,text:string>>", lambda r: _parts(r, limit)
    )
    if ready.places:
        parts = cut(parts, "parts")
        # of conversations in more than one slice: a slice has at most two of them
        ends = parts.groupBy("conv_id", "slice").agg(F.sum(F.size("messages")).alias("n"))
        by = Window.partitionBy("conv_id").orderBy("slice")
        ends = ends.select(
            F.col("conv_id").alias("_conv"), F.col("slice").alias("_slice"),
            F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
            F.lead("n").over(by).isNull().alias("final"),
        ).where("before > 0 or not final")
        parts = parts.join(F.broadcast(ends), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("slice") == F.col("_slice")), "left")
        parts = parts.withColumns({"before": F.coalesce("before", F.lit(0)), "final": F.coalesce("final", F.lit(True))}).drop("_conv", "_slice")

    def render(rows: Iterator[dict]) -> Iterator[dict]:
        built = Template(template)
        for r in rows:
            at = r["nth"] + r.get("before", 0)
            made = built.render([(m["role"], m["text"]) for m in r["messages"]], at, at == 0, r["done"] and r.get("final", True))
            kept = {c: r[c] for c in ("conv_id", "slice", "nth", "alone")}
            spans = [{"start": a, "end": b} for a, b in made.spans]
            yield kept | {"n_turns": len(r["messages"]), "text": "".join(made.texts), "loss": spans, "_size": made.size}

    with shuffles_removed(spark):
        _stream(parts, f"{head}, n_turns int, text string, loss array<struct<start:int,end:int>>", render).write.parquet(folder)


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, parsed from what `write` wrote with
    the default template.

    A digest runs over its conversation from the first turn to the last, so rows of conversations in several parts
    are brought together and read in order, one at a time; all other rows stay where they are.
    """
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def of(rows: Iterator[dict]) -> Iterator[dict]:
        now: dict | None = None
        said = learned = None

        def finished() -> dict:
            return now | {"turns_sha256": said.hexdigest(), "loss_sha256": learned.hexdigest()}

        for r in rows:
            if now is None or r["alone"] or r["conv_id"] != now["conv_id"]:
                if now is not None:
                    yield finished()
                now = {"conv_id": r["conv_id"], "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
                said, learned = hashlib.sha256(), hashlib.sha256()
            for role, text in turns(r["text"]):
                said.update(f"{role}\n{text}\n".encode())
                now["n_turns"] += 1
            for span in r["loss"]:
                text = unescaped(r["text"][span["start"] : span["end"]])
                learned.update(text.encode())
                now["loss_chars"] += len(text)
            now["formatted_chars"] += len(r["text"])
        if now is not None:
            yield finished()

    columns = formatted.select("conv_id", "slice", "nth", "alone", "text", "loss")
    several = columns.where(~F.col("alone")).repartition("conv_id").sortWithinPartitions("conv_id", "slice", "nth")
    return _stream(columns.where("alone"), schema, of).unionByName(_stream(several, schema, of))


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], rows.schema)
    folder = new_folder(spark, "chat")
    write(rows.unionByName(more), folder)
    return digests(spark.read.parquet(folder))

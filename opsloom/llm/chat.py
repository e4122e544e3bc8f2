"""Chat formatting: records of any known layout become turns, turns become marked-up text.

A record's layout is recognised by the hash of its nested field paths (names and nesting, not types or values); the
hash selects a declarative mapping. The text is written in chunks of whole turns, in order, so that a conversation of
any length passes through in bounded memory.
"""
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from opsloom.llm.common import slices, tasks

START, END = "<|im_start|>", "<|im_end|>"
CHUNK_CHARS = 1 << 20
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}

# Layout -> mapping. A mapping is a list of steps: ("one", role, path) makes a turn of the text at a path;
# ("each", path, role field, text field) makes a turn of every element; ("row", order, role, text) is one turn.
LAYOUTS = {
    "rows": ("OBJECT<role, text, turn>", [("row", "turn", "role", "text")]),
    "messages": ("OBJECT<messages: ARRAY<OBJECT<content, role>>>", [("each", "messages", "role", "content")]),
    "system_messages": ("OBJECT<messages: ARRAY<OBJECT<content, role>>, system>",
                        [("one", "system", "system"), ("each", "messages", "role", "content")]),
    "share": ("OBJECT<conversations: ARRAY<OBJECT<from, value>>>", [("each", "conversations", "from", "value")]),
    "prompt_completion": ("OBJECT<completion, prompt>", [("one", "user", "prompt"), ("one", "assistant", "completion")]),
    "prompt_response": ("OBJECT<prompt, response>", [("one", "user", "prompt"), ("one", "assistant", "response")]),
    "instruction": ("OBJECT<instruction, output>", [("one", "user", "instruction"), ("one", "assistant", "output")]),
    "instruction_input": ("OBJECT<input, instruction, output>",
                          [("one", "user", "instruction\n\ninput"), ("one", "assistant", "output")]),
    "question": ("OBJECT<answer, question>", [("one", "user", "question"), ("one", "assistant", "answer")]),
}
SCALARS = r": (STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|BINARY|DATE|TIMESTAMP\w*|DECIMAL\(\d+,\s?\d+\))(?=[,>])"


def fingerprint(record):
    """Hash of the nested field paths of a variant column."""
    return F.xxhash64(field_paths(record))


def field_paths(record):
    return F.regexp_replace(F.schema_of_variant(record), SCALARS, "")


def paths_of(kind) -> str:
    """The nested field paths of a column's type, as `field_paths` gives them for a variant."""
    if isinstance(kind, T.StructType):
        inner = [(f.name, paths_of(f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)]
        return f"OBJECT<{', '.join(name + (nested and ': ' + nested) for name, nested in inner)}>"
    return f"ARRAY<{paths_of(kind.elementType)}>" if isinstance(kind, T.ArrayType) else ""


class FromVariant:
    """Reads fields of a variant column."""

    def __init__(self, record):
        self.record = record

    def get(self, path, kind):
        return F.try_variant_get(self.record, "$." + path, kind)


class FromStruct(FromVariant):
    """Reads fields of a struct column."""

    def get(self, path, kind):
        return self.record[path].cast(kind)


def _text(record, path):
    return F.coalesce(record.get(path, "string"), F.lit(""))


def _turn(part, order, role, text):
    return F.struct(F.lit(part).alias("part"), order.alias("turn"), role.alias("role"), text.alias("text"))


def _element(part, role, text):
    return lambda x, i: _turn(part, i.cast("long"), F.coalesce(x[role], F.lit("")), F.coalesce(x[text], F.lit("")))


def _steps(record, steps):
    """Array of (part, turn, role, text) of one record under a mapping."""
    out = []
    for part, step in enumerate(steps):
        if step[0] == "row":
            _, order, role, text = step
            out.append(F.array(_turn(part, record.get(order, "long"), _text(record, role), _text(record, text))))
        elif step[0] == "one":
            _, role, path = step
            parts = [_text(record, p) for p in path.split("\n\n")]
            out.append(F.array(_turn(part, F.lit(0).cast("long"), F.lit(role), F.concat_ws("\n\n", *[F.when(p != "", p) for p in parts]))))
        else:
            _, path, role, text = step
            rows = F.coalesce(record.get(path, f"array<struct<`{role}`: string, `{text}`: string>>"), F.array())
            out.append(F.transform(rows, _element(part, role, text)))
    return F.concat(*out) if len(out) > 1 else out[0]


def canonical_turns(records: DataFrame, record="record", key="conv_id") -> DataFrame:
    """Turns (conv_id, part, turn, role, text) of records in any known layout: JSON text, or a struct column.

    A struct's layout is the fingerprint of its type, and its fields are read as they are, whatever their length; JSON text is read as a
    variant, which has a size limit. Names of roles are unified, but for rows that already are turns. Null texts and roles are empty; a null turn
    stays null; a null key stays null and forms one conversation. A record whose fingerprint is unknown, or that is no JSON object,
    becomes one turn of role "unknown" with the record as its text.
    """
    spark = records.sparkSession
    known = spark.range(1).select(*[F.xxhash64(F.lit(paths)).alias(name) for name, (paths, _) in LAYOUTS.items()]).first()
    kind = records.schema[record].dataType
    if isinstance(kind, T.StructType):
        own = spark.range(1).select(F.xxhash64(F.lit(paths_of(kind))).alias("h")).first().h
        layout = next((name for name in LAYOUTS if known[name] == own), None)
        if layout is not None:
            turns = _steps(FromStruct(F.col("_r")), LAYOUTS[layout][1])
            return _unified(records.select(F.col(key).cast("long").alias("conv_id"), F.col(record).alias("_r")).select(
                "conv_id", F.explode(turns).alias("t"), F.lit(layout == "rows").alias("_as_is")))
        records = records.withColumn(record, F.to_json(record, {"ignoreNullFields": "false"}))
    v = F.try_parse_json(F.col(record))
    read = records.select(F.col(key).cast("long").alias("conv_id"), F.col(record).alias("_raw"), v.alias("_v"))
    read = read.withColumn("_print", fingerprint(F.col("_v")))
    unknown = F.array(_turn(0, F.lit(0).cast("long"), F.lit("unknown"), F.coalesce(F.col("_raw"), F.lit(""))))
    turns = unknown
    for name, (_, steps) in LAYOUTS.items():
        turns = F.when(F.col("_print") == known[name], _steps(FromVariant(F.col("_v")), steps)).otherwise(turns)
    as_is = F.coalesce(F.col("_print") == known["rows"], F.lit(False)).alias("_as_is")
    return _unified(read.select("conv_id", F.explode(turns).alias("t"), as_is))


def _unified(read: DataFrame) -> DataFrame:
    """Turns with the names of roles that other layouts use brought to one."""
    names = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    role = F.when(F.col("_as_is"), F.col("t.role")).otherwise(F.coalesce(names[F.lower("t.role")], F.col("t.role")))
    return read.select("conv_id", "t.part", "t.turn", role.alias("role"), "t.text")


def escape(text: str) -> str:
    """No control string can stand in the result: each `<`, n backslashes, `|` gets one backslash more."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def formatted(turns: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Formatted text: rows (conv_id, chunk, text); a conversation's text is its chunks joined in order.

    Turns are ordered by (turn, part, role, text), null turns last; repeated rows are repeated turns. Chunks of a conversation stand
    together and in order in one partition.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("text", pa.string())])

    def write(batches):
        key, chunk, parts, size, begun = None, 0, [], 0, False
        for batch in slices(batches):
            done = {"conv_id": [], "chunk": [], "text": []}

            def put():
                done["conv_id"].append(key), done["chunk"].append(chunk), done["text"].append("".join(parts))

            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if begun and (conv != key or size >= chunk_chars):
                    put()
                    chunk, parts, size = (chunk + 1 if conv == key else 0), [], 0
                key, begun = conv, True
                parts.append(format_turn(role or "", text or ""))
                size += len(parts[-1])
            yield pa.RecordBatch.from_pydict(done, schema=schema)
        if begun:
            yield pa.RecordBatch.from_pydict({"conv_id": [key], "chunk": [chunk], "text": ["".join(parts)]}, schema=schema)

    return (turns.repartition(tasks(turns), "conv_id").sortWithinPartitions("conv_id", F.asc_nulls_last("turn"), "part", "role", "text")
            .mapInArrow(write, "conv_id long, chunk long, text string"))


TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)


def parse(text: str):
    """Turns (role, text) of formatted text."""
    return [(unescape_role(r), unescape(t)) for r, t in TURN.findall(text)]


def digests(chunks: DataFrame) -> DataFrame:
    """Read formatted chunks back: per conversation the digests of its turns and of the text under the loss mask,
    which covers each assistant text. Chunks come as `formatted` leaves them."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = pa.schema([(n, pa.string() if n.endswith("256") else pa.int64()) for n in names])

    def read(batches):
        key, state = None, None

        def row():
            return [key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]

        for batch in slices(batches):
            out = []
            for conv, text in zip(batch.column("conv_id").to_pylist(), batch.column("text").to_pylist()):
                if state is None or conv != key:
                    if state is not None:
                        out.append(row())
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[4] += len(text)
                for role, said in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                    if role == "assistant":
                        state[2] += len(said)
                        state[3].update(said.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row(), schema)], schema=schema)

    return chunks.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

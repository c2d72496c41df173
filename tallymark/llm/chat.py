"""Chat formatting by schema fingerprints.

Records come in many layouts.  A record's fingerprint is a hash of its nested
field paths with their kinds; it selects a declarative mapping that says where
roles and texts stand.  The turns found are written in one template, in which
control strings inside texts are escaped so that reading back gives the turns
again, and the places of assistant texts are kept as a loss mask.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD, END = "### ", "</turn>\n"


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    Either ``turns`` names a list whose elements have a ``role`` and a ``text``
    field, or ``fields`` lists (field, role) in order.  Fields of one role that
    follow each other make one turn, joined by a blank line; absent and empty
    optional fields are left out.
    """

    turns: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()
    optional: frozenset[str] = frozenset()
    roles: tuple[tuple[str, str], ...] = ()


_OTHER_NAMES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))


def paths(value: object, prefix: str = "") -> set[str]:
    """Nested field paths with kinds; list elements share one path."""
    if isinstance(value, dict):
        found = {f"{prefix}{{}}"}
        for name, inner in value.items():
            found |= paths(inner, f"{prefix}.{name}")
        return found
    if isinstance(value, list):
        return {f"{prefix}[]"}.union(*(paths(inner, f"{prefix}[]") for inner in value))
    return {f"{prefix}:{'text' if value is None or isinstance(value, str) else type(value).__name__}"}


def fingerprint(value: object) -> str:
    return hashlib.sha256("\n".join(sorted(paths(value))).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def _like(example: dict, mapping: Mapping) -> tuple[str, Mapping]:
    return fingerprint(example), mapping


def known_layouts() -> dict[str, Mapping]:
    """Mappings of common layouts by fingerprint."""
    pair = {"role": "", "content": ""}
    share = {"from": "", "value": ""}
    instruction = (("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant"))
    optional = frozenset(("system", "input"))
    return dict([
        _like({"messages": [pair]}, Mapping("messages", "role", "content")),
        _like({"messages": []}, Mapping("messages", "role", "content")),
        _like({"id": "", "messages": [pair]}, Mapping("messages", "role", "content")),
        _like({"conversations": [share]}, Mapping("conversations", "from", "value", roles=_OTHER_NAMES)),
        _like({"id": "", "conversations": [share]}, Mapping("conversations", "from", "value", roles=_OTHER_NAMES)),
        *[
            _like({a: "", b: ""}, Mapping(fields=((a, "user"), (b, "assistant"))))
            for a, b in (("prompt", "completion"), ("prompt", "response"), ("question", "answer"), ("input", "output"))
        ],
        *[
            _like(dict.fromkeys(names, ""), Mapping(fields=instruction, optional=optional))
            for names in (("instruction", "output"), ("instruction", "input", "output"),
                          ("system", "instruction", "output"), ("system", "instruction", "input", "output"))
        ],
    ])


def turns_of(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    if mapping.turns:
        names = dict(mapping.roles)
        rows = [(t.get(mapping.role) or "", t.get(mapping.text) or "") for t in record.get(mapping.turns) or []]
        return [(names.get(role, role), text) for role, text in rows]
    turns: list[tuple[str, str]] = []
    for field, role in mapping.fields:
        text = record.get(field) or ""
        if not text and field in mapping.optional:
            continue
        if turns and turns[-1][0] == role:
            turns[-1] = (role, f"{turns[-1][1]}\n\n{text}")
        else:
            turns.append((role, text))
    return turns


def escaped(text: str) -> str:
    """No ``###`` and no ``</turn>`` is left in the result."""
    return text.replace("\\", "\\\\").replace("##", "#\\#").replace("</turn>", "<\\/turn>")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The template text and the places (from, to) of assistant texts in it."""
    parts, at, mask = [], 0, []
    for role, text in turns:
        head = f"{HEAD}{escaped(role).replace(':', chr(92) + ':')}: "
        body = escaped(text)
        if role == "assistant":
            mask.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), mask


_HEAD = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.DOTALL)


def read_turns(text: str) -> list[tuple[str, str]]:
    """The turns of a template text."""
    turns = []
    for part in text.split(END)[:-1]:
        head = _HEAD.match(part)
        turns.append((unescaped(head[1]), unescaped(part[head.end() :])))
    return turns


_FORMATTED = "conv_id long, fingerprint string, formatted string, loss_mask array<struct<begin:int,end:int>>"


def _format(layouts: dict[str, Mapping]):
    spans = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, texts, masks = [], [], []
            for raw in batch.column("record").to_pylist():
                record = None if raw is None else json.loads(raw)
                prints.append(None if record is None else fingerprint(record))
                mapping = layouts.get(prints[-1])
                if mapping is None:
                    texts.append(None)
                    masks.append(None)
                    continue
                text, mask = formatted(turns_of(record, mapping))
                texts.append(text)
                masks.append([{"begin": a, "end": b} for a, b in mask])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(prints, pa.string()), pa.array(texts, pa.string()),
                 pa.array(masks, spans)],
                names=["conv_id", "fingerprint", "formatted", "loss_mask"])

    return run


def format_records(records: DataFrame, layouts: dict[str, Mapping] | None = None) -> DataFrame:
    """(conv_id, fingerprint, formatted, loss_mask) of every record.

    ``record`` holds JSON.  Records of an unknown layout stay, with their
    fingerprint and no text, so that a mapping can be added; NULL records have
    neither.  ``loss_mask`` counts characters of ``formatted``.
    """
    rows = records.select(F.col("conv_id").cast("long").alias("conv_id"), "record")
    return rows.mapInArrow(_format(known_layouts() if layouts is None else layouts), _FORMATTED)


def records_of_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, record): one JSON record per conversation of a table of turns.

    Turns go by number, then role, then text; NULL text and role are empty.  A
    user's turn and an answer become a prompt layout, all else a list of
    messages.  Rows without conv_id are one conversation.
    """
    message = F.struct(
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content")
    )
    ordered = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", message.alias("m")))).alias("all")
    )
    rows = ordered.select("conv_id", F.transform("all", lambda x: x["m"]).alias("messages"))
    first, second = F.get("messages", F.lit(0)), F.get("messages", F.lit(1))
    simple = (F.size("messages") == 2) & (first["role"] == "user") & (second["role"] == "assistant")
    pair = F.struct(first["content"].alias("prompt"), second["content"].alias("completion"))
    return rows.select(
        "conv_id", F.when(simple, F.to_json(pair)).otherwise(F.to_json(F.struct("messages"))).alias("record")
    )


_DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, mask in zip(batch.column("formatted").to_pylist(), batch.column("loss_mask").to_pylist()):
            turns = read_turns(text or "")
            loss = "".join(unescaped((text or "")[x["begin"] : x["end"]]) for x in mask or [])
            every = "".join(f"{role}\n{said}\n" for role, said in turns)
            hashes = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (every, loss)]
            rows.append((len(turns), hashes[0], len(loss), hashes[1], len(text or "")))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], names=names)


def digests(rows: DataFrame) -> DataFrame:
    """What reading formatted texts and their masks back gives, as counts and hashes."""
    return rows.select("conv_id", "formatted", "loss_mask").mapInArrow(_digest, _DIGESTS)

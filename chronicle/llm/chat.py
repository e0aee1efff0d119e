"""Chat formatting: any known layout of a conversation to canonical turns, and these to one template.

A record's fingerprint is the hash of its sorted nested field paths, their parts escaped, so that no
field name can pass for a path. It selects a declarative mapping: which path holds the turns, which
the role, which the text; or which flat fields stand for which role; or which fields of a record that
is one turn name its conversation and place. A new layout is one more entry in `MAPPINGS`. A record
with further fields goes to the mapping of most paths among those whose paths it has, unless two fit
alike. A table with one turn in each row gets its mapping once, from its columns or by name (its fields), so further columns
never change how its rows are read; a table that no mapping or more than one fits is refused. Canonical turns are rows (conv_id, turn, role, text).

The template writes a turn as START role NEWLINE text STOP NEWLINE. A backslash in a role or
text is doubled, a `<|` becomes `<\\|` and a role's line break `\\n`, so no control string of the template can come from a
text, and reading undoes it exactly. The loss mask covers the text of assistant turns.

Formatting is by rows. The digest reads each conversation's formatted pieces in order, as a
stream sorted by turn, so a conversation of any length needs no more memory than a batch; its
hash is one chain, so one task follows one conversation.

Null texts and roles are empty. Turns that share a number are ordered by role and text; null
turns come first; null conv_ids are one conversation. A record without turns that can be read is one
row with a null turn, and `layout` says why: `unknown` (no mapping, or two), `unreadable` (no JSON object, or
nested deeper than the parser goes), `empty` (a known layout whose list of turns is empty). `certain` makes the first two an error. Further
columns are further fields of the record. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c

START, STOP = "<|im_start|>", "<|im_end|>"
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant", "chatgpt": "assistant"}

# ---------------------------------------------------------------- layouts


def _part(name: str) -> str:
    """A field name as a part of a path: what paths are joined by is escaped in it."""
    return re.sub(r"[\\.\[\]\n]", lambda m: "\\n" if m[0] == "\n" else f"\\{m[0]}", name)


def paths(value: Any) -> set[str]:
    """The nested field paths of a record; a list's elements share one. An empty list ends in [0], an empty object in a dot."""
    out: set[str] = set()
    todo: list[tuple[Any, str | None]] = [(value, None)]
    while todo:
        v, at = todo.pop()
        if isinstance(v, dict) and v:
            todo += [(x, _part(k) if at is None else f"{at}.{_part(k)}") for k, x in v.items()]
        elif isinstance(v, list) and v:
            todo += [(x, f"{at or ''}[]") for x in v]
        else:
            out.add(f"{at or ''}[0]" if isinstance(v, list) else f"{at or ''}." if isinstance(v, dict) else at or "")
    return out


def fingerprint(field_paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(field_paths)).encode("utf-8", "surrogatepass")).hexdigest()[:16]


def _turns(field: str, role: str, text: str, *more: str) -> dict:
    return {"paths": {f"{field}[].{role}", f"{field}[].{text}", *more}, "turns": field, "role": role, "text": text}


def _flat(*pairs: tuple[str, str]) -> dict:
    """Flat fields in order, each standing for a role; fields of one role in a row are one turn."""
    return {"paths": {f for f, _ in pairs}, "flat": pairs}


def _row(conv: str, turn: str, role: str, text: str) -> dict:
    """A record that is one turn: fields with its conversation, its place in it, its role and its text."""
    return {"paths": {conv, turn, role, text}, "row": (conv, turn, role, text)}


MAPPINGS = {
    fingerprint(m["paths"]): m
    for m in (
        _turns("messages", "role", "content"),
        _turns("messages", "role", "text"),
        _turns("conversations", "from", "value"),
        _turns("conversation", "role", "content"),
        _turns("dialog", "speaker", "text"),
        _turns("turns", "role", "text"),
        {"paths": {"system", "messages[].role", "messages[].content"}, "lead": ("system", "system"), "turns": "messages", "role": "role", "text": "content"},
        {"paths": {"system", "conversations[].from", "conversations[].value"}, "lead": ("system", "system"), "turns": "conversations", "role": "from", "text": "value"},
        _flat(("prompt", "user"), ("completion", "assistant")),
        _flat(("prompt", "user"), ("response", "assistant")),
        _flat(("question", "user"), ("answer", "assistant")),
        _flat(("instruction", "user"), ("output", "assistant")),
        _flat(("instruction", "user"), ("input", "user"), ("output", "assistant")),
        _flat(("instruction", "user"), ("context", "user"), ("response", "assistant")),
        _flat(("system", "system"), ("prompt", "user"), ("response", "assistant")),
        _flat(("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant")),
        _row("conv_id", "turn", "role", "text"),
        _row("conversation_id", "index", "role", "content"),
        _row("thread_id", "position", "speaker", "message"),
    )
}
#: Fingerprints that a worker remembers; more are looked up again.
KNOWN_LAYOUTS = 10_000


def _matched(mapping: dict, found: set[str]) -> int:
    """How many of its paths a mapping finds in a record with further fields; -1: not all that it needs.
    Where the list of turns is empty, no turn can show its fields."""
    needed = mapping["paths"]
    turns = mapping.get("turns")
    if turns and f"{turns}[0]" in found:
        needed = {p for p in needed if not p.startswith(f"{turns}[]")}
    elif not needed <= found:
        return -1
    if not needed <= found or any(_mixed(mapping, p) for p in found - needed):
        return -1
    return len(needed)


def _mapping(found: set[str], named: dict | None = None) -> dict | None:
    """The mapping of these paths; else the one of most paths that all occur beside further fields. A named one goes first, where it fits."""
    if named is not None and _matched(named, found) >= 0:
        return named
    exact = MAPPINGS.get(fingerprint(found))
    if exact is not None:
        return exact
    fits = [(n, m) for m in MAPPINGS.values() if (n := _matched(m, found)) >= 0]
    most = max((n for n, _ in fits), default=0)
    fits = [m for n, m in fits if n == most]
    # of two that fit alike, either would leave out what the other says, unless neither says anything
    return fits[0] if len(fits) == 1 or (fits and all("turns" in m and f"{m['turns']}[0]" in found for m in fits)) else None


def _mixed(mapping: dict, path: str) -> bool:
    """Whether a further path shows a mapped field, or an element of the turns, of another shape."""
    turns = f"{mapping['turns']}[]" if "turns" in mapping else None
    if turns and path.startswith(turns) and not path.startswith(f"{turns}."):
        return True
    return any(path.startswith((f"{p}.", f"{p}[")) for p in mapping["paths"])


Turn = tuple[int | None, int | None, str, str]  # conversation (None: the record's), place, role, text


class Converter:
    """Records to canonical turns; remembers the mapping of each set of paths."""

    def __init__(self, named: dict | None = None) -> None:
        self.named = named
        self.known: dict[frozenset[str], tuple[dict | None, str]] = {}

    def layout(self, record: dict) -> tuple[dict | None, str]:
        """The record's mapping and fingerprint."""
        found = frozenset(paths(record))
        if found not in self.known:
            if len(self.known) >= KNOWN_LAYOUTS:
                self.known.clear()
            self.known[found] = (_mapping(set(found), self.named), fingerprint(set(found)))
        return self.known[found]

    def turns(self, record: Any) -> tuple[list[Turn] | None, str, str]:
        """Canonical turns (None: there are none to read), what the layout is, and the fingerprint."""
        if not isinstance(record, dict):
            return None, "unreadable", ""
        mapping, mark = self.layout(record)
        if mapping is None:
            return None, "unknown", mark
        if "row" in mapping:
            conv, turn, role, text = (record[f] for f in mapping["row"])
            if not all(x is None or (type(x) is int and -(2**63) <= x < 2**63) for x in (conv, turn)):
                return None, "unknown", mark
            return [(conv, turn, _text(role), _text(text))], "turn", mark
        out: list[tuple[str, str]] = []
        if "flat" in mapping:
            for field, role in mapping["flat"]:
                text = _text(record[field])
                if not text and role != "assistant":
                    continue
                if out and out[-1][0] == role:
                    out[-1] = (role, f"{out[-1][1]}\n\n{text}")
                else:
                    out.append((role, text))
            return [(None, i, r, t) for i, (r, t) in enumerate(out)], "flat", mark
        if "lead" in mapping and record[mapping["lead"][0]]:
            out.append((mapping["lead"][1], _text(record[mapping["lead"][0]])))
        for turn in record[mapping["turns"]]:
            role = _text(turn.get(mapping["role"]))
            out.append((ROLES.get(role.lower(), role), _text(turn.get(mapping["text"]))))
        return ([(None, i, r, t) for i, (r, t) in enumerate(out)], "turns", mark) if out else (None, "empty", mark)


def record_turns(record: Any) -> list[tuple[str, str]] | None:
    """Canonical (role, text) of a record of a known layout."""
    turns, _, _ = Converter().turns(record)
    return None if turns is None else [(role, text) for _, _, role, text in turns]


def _text(x: Any) -> str:
    x = "" if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)
    try:
        x.encode()
    except UnicodeEncodeError:  # half of a pair, which only an escape in JSON can say
        x = x.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return x


def _parsed(raw: str | None) -> Any:
    try:
        return json.loads(raw or "null")
    except (ValueError, RecursionError):
        return None


def canonical(records: DataFrame, id_col: str, json_col: str, named: dict | None = None) -> DataFrame:
    """(conv_id, turn, role, text, layout, fingerprint) of JSON records; a record without turns is one row with a null turn, role and text."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        converter = Converter(named)
        for batch in batches:
            rows: list[tuple] = []
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                turns, layout, mark = converter.turns(_parsed(raw))
                if turns is None:
                    rows.append((key, None, None, None, layout, mark))
                else:
                    rows += [(conv if layout == "turn" else key, turn, role, text, layout, mark) for conv, turn, role, text in turns]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["conv_id", "turn", "role", "text", "layout", "fingerprint"])

    return c.bounded(records).select(F.col(id_col).cast("long"), F.col(json_col)).mapInArrow(convert, "conv_id long, turn long, role string, text string, layout string, fingerprint string")


def row_records(table: DataFrame) -> DataFrame:
    """(id, record): each row of a table as one JSON record of all its columns, nulls among them."""
    return table.select(F.lit(None).cast("long").alias("id"), F.to_json(F.struct(*(F.col(f"`{x}`") for x in table.columns)), {"ignoreNullFields": "false"}).alias("record"))


def row_mapping(columns: list[str], fields: tuple[str, str, str, str] | None = None) -> dict:
    """The mapping of a table with one turn in each row: that of the named fields (conversation, place, role, text), else the one that fits its columns."""
    if fields is not None:
        missing = [f for f in fields if f not in columns]
        if missing:
            raise ValueError(f"the table has no columns {missing}")
        return _row(*map(_part, fields)) | {"row": fields}
    fits = [m for m in MAPPINGS.values() if "row" in m and m["paths"] <= set(columns)]
    if len(fits) != 1:
        raise ValueError(f"name the fields of a turn: the columns fit {[m['row'] for m in fits] or 'no mapping'}")
    return fits[0]


def certain(found: DataFrame) -> DataFrame:
    """Canonical turns as they are; a record that no mapping, or more than one, can read is an error when it is reached."""
    said = F.concat(F.lit("no certain mapping for a record: "), "layout", F.lit(" "), "fingerprint")
    return found.withColumn("layout", F.when(F.col("layout").isin("unknown", "unreadable"), F.raise_error(said)).otherwise(F.col("layout")))


def canonical_rows(table: DataFrame, fields: tuple[str, str, str, str] | None = None) -> DataFrame:
    """(conv_id, turn, role, text) of a table with one turn in each row."""
    found = certain(canonical(row_records(table), "id", "record", row_mapping(table.columns, fields)))
    return found.where("layout = 'turn'").select("conv_id", "turn", "role", "text")


# ---------------------------------------------------------------- template


def escaped(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(x: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], x, flags=re.S)


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text as given, and piece (this turn in the template), loss_start and loss_end in it (equal: no loss)."""
    text, role = escaped(F.col("text")), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\n"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    lead = F.char_length(head).cast("long")
    return turns.withColumns({
        "piece": F.concat(head, text, F.lit(f"{STOP}\n")),
        "loss_start": lead,
        "loss_end": F.when(F.col("role") == "assistant", lead + F.char_length(text)).otherwise(lead),
    })


def read(piece: str) -> Iterator[tuple[str, str]]:
    """The turns of a formatted text."""
    at = 0
    while at < len(piece):
        if not piece.startswith(START, at):
            raise ValueError(f"no turn at {at}")
        line = piece.index("\n", at)
        stop = piece.index(f"{STOP}\n", line)
        yield unescaped(piece[at + len(START) : line]), unescaped(piece[line + 1 : stop])
        at = stop + len(STOP) + 1


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follows the sorted pieces; one row for each conversation."""
    done: list[tuple] = []
    key: tuple | None = None
    turns, loss = hashlib.sha256(), hashlib.sha256()
    n = chars = size = 0

    def flushed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    for batch in batches:
        for conv, piece, start, end in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (conv,) != key:
                if key is not None:
                    done.append((key[0], n, turns.hexdigest(), chars, loss.hexdigest(), size))
                key, n, chars, size = (conv,), 0, 0, 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            for role, text in read(piece):
                n += 1
                turns.update(f"{role}\n{text}\n".encode())
            masked = unescaped(piece[start:end])
            chars += len(masked)
            loss.update(masked.encode())
            size += len(piece)
        if len(done) > 10000:
            yield flushed(done)
            done = []
    if key is not None:
        done.append((key[0], n, turns.hexdigest(), chars, loss.hexdigest(), size))
    yield flushed(done)


def digests(turns: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its formatted turns."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    pieces = formatted(c.bounded(turns)).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "piece", "loss_start", "loss_end")
    return pieces.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

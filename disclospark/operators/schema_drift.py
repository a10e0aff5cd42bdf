"""Payloads whose layout drifts from file to file: one table, and a list of every change.

A file is a (group, batch). Its schema graph has the keys and nested paths found in it, with their JSON types, words of their names, nesting and order. What a
path holds is counted: how often its value equals each known column of the same row. Similarity flooding runs on the pairs of a file's graph and the graph of the known
columns: pairs start at their share of equal content, words and types at their likeness, and each pair passes its score on to the pairs
its elements lead to, until nothing moves; a path takes the column of highest score that its content doesn't speak against (no path and no column
twice). Where no row can be compared, content is silent and a path can't be known so; for these the graphs of neighbouring files are flooded against each other, and a silent path takes the
column of the path it corresponds to. Payloads are read and counted in one pass inside Arrow batches, and counts added up map-side first; only
the counts, a few numbers for each path of each file, reach the matcher, one group at a time.

Cases: null, malformed (a number that JSON doesn't know included) and non-object payloads hold no key, and payload_problems() counts them; of a repeated key the last value holds,
and it is counted as well; an empty object holds no key; a file without keys lost them all; keys that are always null have no type and are never retyped; numbers of any
size are one type; all members of nested objects and arrays are paths of their own (`key.member`, `key[0]`; `.`, `[` and `\\` of a name bear a backslash); a null in the place of
an object or array that bears columns is the null of these columns; empty input gives no rows.
"""

from __future__ import annotations

import difflib
import functools
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import RAW_FIELDS
from ..session import materialize

_TYPES = ("string", "number", "boolean", "object", "array")
#: Least share of comparable rows in which a path must equal a column to be that column.
FLOOR = 0.5
#: Least flooded score, of a largest one of 1, by which a path without content takes the meaning of its neighbour's path.
SILENT_FLOOR = 0.2
#: Layouts are broadcast up to this many files (some hundred bytes each); more are joined by a shuffle.
BROADCAST_FILES = 100_000


# reading


class _Number(str):
    """A number as it was written."""


_KINDS = {type(None): None, bool: "boolean", _Number: "number", str: "string", dict: "object", list: "array"}


def _refuse(token: str) -> None:
    raise ValueError(token)


def _decoder(repeated: list) -> json.JSONDecoder:
    def pairs(items: list) -> dict:
        out = dict(items)
        if len(out) != len(items):
            repeated.append(1)
        return out

    return json.JSONDecoder(object_pairs_hook=pairs, parse_int=_Number, parse_float=_Number, parse_constant=_refuse)


def _kind(v: object) -> str | None:
    return _KINDS[type(v)]


@functools.lru_cache(1 << 16)
def _name(key: str) -> str:
    return re.sub(r"[\\.\[]", r"\\\g<0>", key)


def leaves(path: str, v: object) -> Iterator[tuple[str, str | None, str | None]]:
    """(path, type, text) of every value nested in one, without recursion: nesting may be deep."""
    stack = [(path, v)]
    while stack:
        at, x = stack.pop()
        if isinstance(x, dict):
            stack += [(f"{at}.{_name(k)}", y) for k, y in reversed(x.items())]
        elif isinstance(x, list):
            stack += [(f"{at}[{i}]", y) for i, y in reversed(list(enumerate(x)))]
        else:
            yield at, _kind(x), None if x is None else ("true" if x else "false") if isinstance(x, bool) else str(x)


def holders(paths: Iterable[str]) -> set[str]:
    """The paths of all objects and arrays that these paths lie in."""
    return {p[: m.start()] for p in paths for m in re.finditer(r"\\.|[.\[]", p) if m[0][0] != "\\"}


def read_payload(text: str | None, decoder: json.JSONDecoder, repeated: list) -> tuple[dict | None, str | None]:
    """(object, problem): malformed and not_an_object come without an object, repeated_key with one."""
    if text is None:
        return None, None
    repeated.clear()
    try:
        v = decoder.decode(text)
    except (ValueError, RecursionError):
        return None, "malformed"
    if not isinstance(v, dict):
        return None, "not_an_object"
    return v, "repeated_key" if repeated else None


def profile(df: DataFrame, payload: str, group: str, batch: str, columns: tuple[str, ...]) -> DataFrame:
    """A row a (grp, batch, key, path, kind): rows, summed position, and for each column the comparable and the equal rows.

    Rows with path '' tell how often a key has a type; rows without key count problems, named by path, and one without path the file's rows.
    """
    counts = [f"n_{c}" for c in columns] + [f"e_{c}" for c in columns]
    names = ["grp", "batch", "key", "path", "kind", "rows", "pos", *counts]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * (2 + len(counts))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated: list = []
        decoder = _decoder(repeated)
        for b in batches:
            grp, no, texts, *own = (c.to_numpy(zero_copy_only=False).tolist() for c in b.columns)
            files: dict[tuple, tuple[Counter, dict, dict]] = {}
            for g, n, text, values in zip(grp, no, texts, zip(*own, strict=True) if own else [()] * len(grp), strict=True):
                if (g, n) not in files:
                    files[g, n] = (Counter(), {}, {})
                said, tops, paths = files[g, n]
                said[None] += 1
                top, problem = read_payload(text, decoder, repeated)
                if problem:
                    said[problem] += 1
                if not top:
                    continue
                where: dict[str, list[int]] = {}
                mask = 0
                for i, v in enumerate(values):
                    if v is not None:
                        mask |= 1 << i
                        where.setdefault(v, []).append(i)
                for pos, (key, v) in enumerate(top.items()):
                    kind = _KINDS[type(v)]
                    t = tops.get((key, kind))
                    if t is None:
                        t = tops[key, kind] = [0, 0]
                    t[0] += 1
                    t[1] += pos
                    for path, leaf_kind, leaf in ((_name(key), kind, v),) if kind == "string" or kind == "number" or kind is None else leaves(_name(key), v):
                        p = paths.get((key, path, leaf_kind))
                        if p is None:
                            p = paths[key, path, leaf_kind] = [0, {}, [0] * len(columns)]
                        p[0] += 1
                        if leaf:
                            p[1][mask] = p[1].get(mask, 0) + 1
                            if leaf in where:
                                for i in where[leaf]:
                                    p[2][i] += 1
            none = [0] * (2 * len(columns))
            rows = []
            for (g, n), (said, tops, paths) in files.items():
                rows += [(g, n, None, problem, None, k, 0, *none) for problem, k in said.items()]
                rows += [(g, n, key, "", kind, k, pos, *none) for (key, kind), (k, pos) in tops.items()]
                for (key, path, kind), (k, masks, equal) in paths.items():
                    usable = [sum(m for mask, m in masks.items() if mask >> i & 1) for i in range(len(columns))]
                    rows.append((g, n, key, path, kind, k, 0, *usable, *equal))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names=names)

    chosen = df.select(F.col(group).cast("string"), F.col(batch).cast("int"), payload, *[F.col(c).cast("string").alias(f"c_{c}") for c in columns])
    schema = "grp string, batch int, key string, path string, kind string, " + ", ".join(f"`{c}` long" for c in names[5:])
    return chosen.mapInArrow(run, schema).groupBy(*names[:5]).agg(*[F.sum(c).alias(c) for c in names[5:]])


# matching


def _words(name: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower()).split()


def _like(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


def similarity_flooding(a: list[tuple], b: list[tuple], start: dict[tuple, float], rounds: int = 200) -> dict[tuple, float]:
    """Scores of pairs of nodes of two graphs, each a list of (node, label, node), to a fixed point; the largest is one.

    A pair leads to another if both elements do under one label; it gives its score in equal parts to all it leads to by that label, and back.
    """
    at: dict[tuple, int] = {p: i for i, p in enumerate(start)}
    by_label: dict[str, list[tuple]] = {}
    for x, label, y in b:
        by_label.setdefault(label, []).append((x, y))
    src, dst, tag = [], [], []
    for x, label, y in a:
        for u, v in by_label.get(label, ()):
            src.append(at.setdefault((x, u), len(at)))
            dst.append(at.setdefault((y, v), len(at)))
            tag.append(label)
    s0 = np.zeros(len(at))
    s0[: len(start)] = list(start.values())
    if not src:
        return dict(zip(at, s0 / (s0.max(initial=0.0) or 1.0), strict=True))
    out, back = Counter(zip(src, tag, strict=True)), Counter(zip(dst, tag, strict=True))
    source, target = np.array(src), np.array(dst)
    forth = np.array([1.0 / out[s, t] for s, t in zip(src, tag, strict=True)])
    again = np.array([1.0 / back[d, t] for d, t in zip(dst, tag, strict=True)])
    s = s0
    for _ in range(rounds):
        now = s0 + s
        new = now + np.bincount(target, now[source] * forth, len(at)) + np.bincount(source, now[target] * again, len(at))
        new /= new.max() or 1.0
        done = np.abs(new - s).max() < 1e-6
        s = new
        if done:
            break
    return dict(zip(at, s, strict=True))


class _File:
    """Schema graph and contents of one file."""

    def __init__(self, counts: pd.DataFrame, columns: tuple[str, ...]) -> None:
        self.columns = columns
        self.types: dict[str, dict[str | None, int]] = {}
        self.key_of: dict[str, str] = {}
        self.usable: dict[str, np.ndarray] = {}
        self.equal: dict[str, np.ndarray] = {}
        kinds: dict[str, set] = {}
        place: dict[str, np.ndarray] = {}
        numbers = counts[[*[f"n_{c}" for c in columns], *[f"e_{c}" for c in columns]]].to_numpy(np.int64)
        for key, path, kind, rows, pos, row in zip(counts["key"], counts["path"], counts["kind"], counts["rows"], counts["pos"], numbers, strict=True):
            if path == "":
                self.types.setdefault(key, {})[kind] = rows
                place[key] = place.get(key, 0) + np.array([pos, rows])
            else:
                self.key_of[path] = key
                self.usable[path] = self.usable.get(path, 0) + row[: len(columns)]
                self.equal[path] = self.equal.get(path, 0) + row[len(columns) :]
                kinds.setdefault(path, set()).update([kind] if kind else [])
        self.keys = sorted(self.types, key=lambda k: (place[k][0] / place[k][1], k))
        self.graph = [("file", "child", ("key", k)) for k in self.keys] + [(("key", x), "next", ("key", y)) for x, y in zip(self.keys, self.keys[1:], strict=False)]
        for p, key in sorted(self.key_of.items()):
            self.graph += [(("key", key), "holds", p)] + [(p, "type", ("type", t)) for t in sorted(kinds[p])] + [(p, "name", ("word", w)) for w in _words(p)]
        self.found: dict[str, str] = {}

    def silent(self, path: str, column: str) -> bool:
        """No row tells whether the path is the column."""
        return not self.usable[path][self.columns.index(column)]

    def type_of(self, key: str) -> str | None:
        t = self.types[key]
        best = max(_TYPES, key=lambda k: t.get(k, 0))
        return best if t.get(best) else None


def _nodes(graph: list[tuple], kind: str) -> list[tuple]:
    return sorted({y for _, _, y in graph if isinstance(y, tuple) and y[0] == kind})


def _likeness(a: list[tuple], b: list[tuple]) -> dict[tuple, float]:
    """Where the flooding starts: words by their letters, types by equality, the roots as one."""
    start = {("file", "file"): 1.0}
    start |= {(x, y): _like(x[1], y[1]) for x in _nodes(a, "word") for y in _nodes(b, "word")}
    start |= {(x, y): 1.0 if x == y else 0.2 for x in _nodes(a, "type") for y in _nodes(b, "type")}
    return start


def _pick(scored: list[tuple[float, str, str]]) -> Iterator[tuple[str, str]]:
    used_a, used_b = set(), set()
    for _, a, b in sorted(scored, key=lambda x: (-x[0], x[1], x[2])):
        if a not in used_a and b not in used_b:
            used_a.add(a)
            used_b.add(b)
            yield a, b


def _match_columns(f: _File, columns: tuple[str, ...]) -> None:
    target = [("file", "child", ("key", c)) for c in columns] + [(("key", c), "holds", c) for c in columns]
    target += [x for c in columns for x in ((c, "type", ("type", "string")), *[(c, "name", ("word", w)) for w in _words(c)])]
    share = {(p, c): f.equal[p][i] / f.usable[p][i] if f.usable[p][i] else 0.0 for p in f.key_of for i, c in enumerate(columns)}
    score = similarity_flooding(f.graph, target, share | _likeness(f.graph, target))
    f.found = dict(_pick([(score[pc], *pc) for pc, s in share.items() if s >= FLOOR]))


def _match_silent(f: _File, other: _File) -> None:
    """Paths of `f` without content take the column of the path of a neighbouring file that they correspond to."""
    free = {p: c for p, c in other.found.items() if c not in f.found.values()}
    silent = [p for p in f.key_of if p not in f.found and any(f.silent(p, c) for c in free.values())]
    if not silent:
        return
    known = {c: p for p, c in f.found.items()}
    start = {}
    for p in f.key_of:
        for q in other.key_of:
            mine, theirs = f.found.get(p), other.found.get(q)
            both = mine is not None and theirs is not None
            start[p, q] = (1.0 if mine == theirs else 0.0) if both else 0.0 if mine or theirs in known else _like(" ".join(_words(p)), " ".join(_words(q)))
    score = similarity_flooding(f.graph, other.graph, start | _likeness(f.graph, other.graph))
    top = max((score[pq] for pq in start), default=0.0) or 1.0
    rivals = [(score[p, q] / top, p, q) for p in silent for q in other.key_of if q in free or q not in other.found]
    for p, q in _pick(rivals):
        if q in free and f.silent(p, free[q]) and score[p, q] / top >= SILENT_FLOOR:
            f.found[p] = free[q]


def match_files(counts: pd.DataFrame, columns: tuple[str, ...]) -> dict[int, _File]:
    """The files of one group in order, each with `found`, the column of each path that has one."""
    files = {int(b): _File(own[own["key"].notna()], columns) for b, own in counts.groupby("batch")}
    for f in files.values():
        _match_columns(f, columns)
    order = list(files.values())
    for row in (order, order[::-1]):  # meanings travel forth, then back
        for before, f in zip(row, row[1:], strict=False):
            _match_silent(f, before)
    return files


def _changes(columns: tuple[str, ...]):  # noqa: ANN202
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fields = {}
        for b, f in match_files(pdf, columns).items():
            known = {("known", c): f.key_of[p] for p, c in f.found.items()}
            others = {("other", k): k for k in f.keys if k not in known.values()}
            fields[b] = {x: (k, f.type_of(k)) for x, k in (known | others).items()}
        out = []
        for (_, old), (b, new) in zip(fields.items(), list(fields.items())[1:], strict=False):
            for f in sorted(old.keys() | new.keys()):
                if f not in new:
                    out.append((b, "removed", old[f][0], ""))
                elif f not in old:
                    out.append((b, "added", "", new[f][0]))
                else:
                    (k0, t0), (k1, t1) = old[f], new[f]
                    if k0 != k1:
                        out.append((b, "renamed", k0, k1))
                    if t0 and t1 and t0 != t1:
                        out.append((b, "retyped", k1, k1))
        frame = pd.DataFrame(out, columns=["batch", "change_kind", "old_key", "new_key"])
        frame.insert(0, "grp", key[0])
        return frame.astype({"batch": "int32"})

    return run


def _layouts(columns: tuple[str, ...]):  # noqa: ANN202
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(key[0], b, json.dumps(f.found)) for b, f in match_files(pdf, columns).items()]
        return pd.DataFrame(rows, columns=["grp", "batch", "layout"]).astype({"batch": "int32"})

    return run


# results


def payload_problems(df: DataFrame, payload: str, group: str, batch: str) -> DataFrame:
    """(group, batch, problem, rows): malformed, not_an_object and repeated_key payloads of each file."""
    found = profile(df, payload, group, batch, ()).filter("key is null and path is not null")
    return found.select(F.col("grp").alias(group), F.col("batch").alias(batch), F.col("path").alias("problem"), "rows")


def schema_changes(df: DataFrame, payload: str, group: str, batch: str, columns: tuple[str, ...] = RAW_FIELDS) -> DataFrame:
    """(group, batch, change_kind, old_key, new_key) of each file against the group's file before it."""
    out = profile(df, payload, group, batch, columns).groupBy("grp").applyInPandas(
        _changes(columns), "grp string, batch int, change_kind string, old_key string, new_key string"
    )
    return out.withColumnsRenamed({"grp": group, "batch": batch})


def unified_table(df: DataFrame, payload: str, group: str, batch: str, row: str, columns: tuple[str, ...] = RAW_FIELDS) -> DataFrame:
    """One row an input row: `row`, group, batch, the known columns read from the payload (null where it has none), and `others`, the rest as a JSON object of paths in order."""
    prof = profile(df, payload, group, batch, columns)
    layouts = materialize(prof.groupBy("grp").applyInPandas(_layouts(columns), "grp string, batch int, layout string"))
    if layouts.count() <= BROADCAST_FILES:
        layouts = F.broadcast(layouts)
    keyed = df.select(row, group, batch, F.col(payload).alias("#payload"), F.col(group).cast("string").alias("grp"), F.col(batch).cast("int").alias("#batch"))
    laid = keyed.join(layouts.withColumnRenamed("batch", "#batch"), ["grp", "#batch"], "left").select(row, group, batch, "#payload", "layout")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated: list = []
        decoder, known = _decoder(repeated), {}
        for b in batches:
            cols: dict[str, list] = {c: [] for c in (*columns, "others")}
            for text, layout in zip(*(b.column(i).to_numpy(zero_copy_only=False).tolist() for i in (3, 4)), strict=True):
                if layout not in known:
                    found = json.loads(layout or "{}")
                    known[layout] = found, holders(found)
                (fields, above), got, rest = known[layout], {}, {}
                top, _ = read_payload(text, decoder, repeated)
                for key, v in (top or {}).items():
                    for path, _, leaf in leaves(_name(key), v):
                        if path in fields:
                            got[fields[path]] = leaf
                        elif leaf is not None or path not in above:
                            rest[path] = leaf
                for c in columns:
                    cols[c].append(got.get(c))
                cols["others"].append(None if top is None else json.dumps(rest, ensure_ascii=False, separators=(",", ":"), sort_keys=True))
            yield pa.record_batch([*b.columns[:3], *[pa.array(v, pa.string()) for v in cols.values()]], names=[*b.schema.names[:3], *cols])

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in laid.schema.fields[:3]] + [f"`{c}` string" for c in (*columns, "others")]
    return laid.mapInArrow(run, ", ".join(schema))

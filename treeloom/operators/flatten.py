"""Source texts to a relational syntax table.

The parse of one file is the only step that runs in Python. It numbers the
nodes of the tree and records for each node the few facts about its
surroundings that later steps need, so that node ids, parents, enclosing
functions, next statements, last definitions and called functions are plain
projections: all of them lie within one text, which the parse holds anyway.
"""

from __future__ import annotations

import ast
import gc
import warnings
from collections.abc import Iterable, Iterator
from operator import itemgetter
from typing import get_args

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from treeloom import schemas
from treeloom.functions import ids

# Node kinds and fields the graph rules name.
MODULE = ids.MODULE
FUNCTION_KINDS = ("FunctionDef", "AsyncFunctionDef")
BLOCK_FIELDS = ("body", "orelse", "finalbody")
NAME_FIELD = {
    "FunctionDef": "name",
    "AsyncFunctionDef": "name",
    "ClassDef": "name",
    "Name": "id",
    "Attribute": "attr",
}
IO_ERROR = "io_error"
SYNTAX_ERROR = "syntax_error"

ROWS_PER_BATCH = 20_000

_INPUT = ("unit", "file_path", "text", "bad_content", "read_error", "file_hash", "size_bytes", "loc")
_FILE_COLUMNS = ("unit", "file_path")
_MEASURES = ("file_hash", "size_bytes", "loc", "error_type", "error_message")
# A row that stands for no other: no parent with a position, no function around, no next statement.
_NONE = -1
# What a kind of node notes beside its place.
_UNPLACED, _PLACED, _NAMED, _NAME, _CALL, _FUNCTION = range(6)


class _Kinds(dict):
    """Class of a node to its code, what it notes and its fields with nodes, last first.

    Marker nodes without fields or position, and what is no node, have none. ``names`` has the kind of each code.
    """

    def __init__(self):
        super().__init__()
        self.names: list[str] = []

    def code(self, name: str) -> int:
        if name not in self.names:
            self.names.append(name)
        return self.names.index(name)

    def __missing__(self, cls: type) -> tuple | None:
        self[cls] = self._described(cls)
        return self[cls]

    def _described(self, cls: type) -> tuple | None:
        if not issubclass(cls, ast.AST) or not (cls._fields or cls._attributes):
            return None
        kind, role = cls.__name__, _UNPLACED
        if "lineno" in cls._attributes:
            role = {"Name": _NAME, "Call": _CALL}.get(kind, _NAMED if kind in NAME_FIELD else _PLACED)
            role = _FUNCTION if kind in FUNCTION_KINDS else role
        hints = getattr(cls, "_field_types", {})
        fields = [(f, f in BLOCK_FIELDS) for f in reversed(cls._fields) if self._holds_nodes(hints.get(f, ast.AST))]
        return self.code(kind), role, NAME_FIELD.get(kind), tuple(fields)

    def _holds_nodes(self, hint) -> bool:
        return any(
            isinstance(t, type) and issubclass(t, ast.AST) and not issubclass(t, _MARKERS)
            for t in get_args(hint) or (hint,)
        )


_MARKERS = (ast.expr_context, ast.boolop, ast.operator, ast.unaryop, ast.cmpop)
_KINDS = _Kinds()
_MODULE_CODE = _KINDS.code(MODULE)


def _callee(call: ast.Call) -> str | None:
    kind = type(call.func).__name__
    return getattr(call.func, NAME_FIELD[kind]) if kind in ("Name", "Attribute") else None


class _Rows:
    """Rows of several files, as one list per fact; what few rows have lies beside the numbers of those rows.

    Other nodes are noted as row numbers, whose positions are looked up for all rows at once.
    """

    def __init__(self):
        self.codes: list[int] = []
        self.pre: list[int] = []
        self.depth: list[int] = []
        self.up: list[int] = []
        self.line: list[int] = []
        self.col: list[int] = []
        self.end: list[int] = []
        self.named: tuple[list, list] = ([], [])
        self.reads: tuple[list, list, list, list] = ([], [], [], [])
        self.calls: tuple[list, list, list, list] = ([], [], [], [])
        self.statements: tuple[list, list, list, list] = ([], [], [], [])

    def __len__(self) -> int:
        return len(self.codes)

    def _bare(self, code: int) -> None:
        """A row without a position: a module, or a file that failed."""
        for column, value in (
            (self.codes, code), (self.pre, 0), (self.depth, 0), (self.up, _NONE),
            (self.line, 0), (self.col, 0), (self.end, 0),
        ):
            column.append(value)

    def add_failure(self) -> None:
        self._bare(_NONE)

    def add_tree(self, tree: ast.Module) -> None:
        """Rows of one tree in pre-order.

        An explicit stack replaces recursion, so the depth of a tree is not limited. ``block``
        identifies a statement list that control flow walks: a list of that kind reached from
        the module through such lists only. Its first member fixes its ``block_pre``, and each
        member notes the row of the one after it. Marker nodes without fields or position are left out.
        """
        self._bare(_MODULE_CODE)
        codes, pres, depths, ups = self.codes, self.pre, self.depth, self.up
        name_rows, names = self.named
        call_rows, callees, enclosings, called = self.calls
        statements, block_pres, block_idxs, followings = self.statements
        kinds, placed, uses, functions = _KINDS, [], [], {}
        first_call = len(call_rows)
        # Enclosing function and the scopes around; then the block a statement is in and its place there.
        around = (_NONE, (0,))
        stack: list[tuple] = [(tree, 0, _NONE, around, [], None)]
        pre = 0
        while stack:
            node, depth, up, around, block, idx = stack.pop()
            kind = kinds[type(node)]
            if kind is None:
                continue
            code, role, name_field, fields = kind
            if role:
                row = len(codes)
                codes.append(code)
                pres.append(pre)
                depths.append(depth)
                ups.append(up)
                placed.append(node)
                if role == _NAME:
                    name_rows.append(row)
                    names.append(node.id)
                    uses.append((depth, row, node.id, type(node.ctx), around[1]))
                    pre += 1
                    continue
                if name_field:
                    name_rows.append(row)
                    names.append(getattr(node, name_field))
                if role == _CALL:
                    call_rows.append(row)
                    callees.append(_callee(node))
                    enclosings.append(around[0])
                elif role == _FUNCTION:
                    if node.name not in functions or depth < functions[node.name][0]:
                        functions[node.name] = depth, row
                    around = (row, (*around[1], pre))
                if block is not None:
                    if block:
                        followings[block[1]] = row
                        block[1] = len(statements)
                    else:
                        block += (pre, len(statements))
                    statements.append(row)
                    block_pres.append(block[0])
                    block_idxs.append(idx)
                    followings.append(_NONE)
                up = row
            if fields:
                depth += 1
                for field, walks in fields:
                    value = getattr(node, field, None)
                    if type(value) is not list:
                        if value is not None:
                            stack.append((value, depth, up, around, None, None))
                    elif walks and block is not None:
                        members: list[int] = []
                        for i in range(len(value) - 1, -1, -1):
                            stack.append((value[i], depth, up, around, members, i))
                    else:
                        for child in reversed(value):
                            stack.append((child, depth, up, around, None, None))
            pre += 1
        self.line += [n.lineno for n in placed]
        self.col += [n.col_offset for n in placed]
        self.end += [n.end_lineno for n in placed]
        none = (0, _NONE)
        called += [functions.get(name, none)[1] for name in callees[first_call:]]
        self._add_reads(uses)

    def _add_reads(self, uses: list[tuple]) -> None:
        """Last assignment of a name before each read of it, per scope, breadth first.

        A name counts in every scope around it. ``uses`` are in pre-order.
        """
        read_rows, counts, scopes, definitions = self.reads
        last: dict[tuple, int] = {}
        for _, row, name, context, around in sorted(uses, key=itemgetter(0)):
            if context is ast.Store:
                for scope in around:
                    last[scope, name] = row
            elif context is ast.Load:
                before = len(scopes)
                for scope in around:
                    if (scope, name) in last:
                        scopes.append(scope)
                        definitions.append(last[scope, name])
                if len(scopes) > before:
                    read_rows.append(row)
                    counts.append(len(scopes) - before)

    def holding(self, facts: Iterable[str]) -> np.ndarray | slice:
        """Numbers of the rows that have one of the facts, which few rows have; all rows if none is named."""
        rows = {"block_idx": self.statements[0], "defs": self.reads[0], "callee": self.calls[0]}
        found = [np.array(rows[fact], np.int64) for fact in facts]
        return np.unique(np.concatenate(found)) if found else slice(None)

    def columns(
        self, types: dict[str, pa.DataType], wanted: list[str], kept: np.ndarray | slice = slice(None)
    ) -> dict[str, pa.Array]:
        """Arrow columns that are ``wanted`` of the rows ``kept``, but for those that a file has once."""
        codes, up = np.array(self.codes, np.int64), np.array(self.up, np.int64)
        line, col = np.array(self.line, np.int32), np.array(self.col, np.int32)
        kinds = pa.array(_KINDS.names, types["node_type"])
        place = ((codes >= 0) & (codes != _MODULE_CODE))[kept]

        def spread(rows: list, values: list) -> np.ndarray:
            whole = np.full(len(codes), _NONE, np.int64)
            whole[rows] = values
            return whole[kept]

        def of_rows(rows: list, values: pa.Array) -> pa.Array:
            at = spread(rows, np.arange(len(rows)))
            return values.take(pa.array(at, mask=at < 0))

        def numbers(rows: list, values: list) -> pa.Array:
            at = spread(rows, values)
            return pa.array(at, pa.int32(), mask=at < 0)

        def position(name: str, find, known) -> dict:
            """Place of the rows that ``find`` gives, where ``known``; of the module where it is none."""

            def column(place, type_=None):
                rows = find()
                return pa.array(place(rows, rows < 0), type_, mask=~known(rows))

            return {
                f"{name}_line": lambda: column(lambda r, none: np.where(none, ids.NO_POSITION, line[r])),
                f"{name}_col": lambda: column(lambda r, none: np.where(none, ids.NO_POSITION, col[r])),
                f"{name}_type": lambda: kinds.take(
                    column(lambda r, none: np.where(none, _MODULE_CODE, codes[r]))
                ),
            }

        def definitions() -> pa.Array:
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts, dtype=np.int32))), pa.int32())
            at = np.array(defined, np.int64)
            item = types["defs"].value_type
            places = [pa.array(scopes, pa.int32()), pa.array(line[at]), pa.array(col[at])]
            listed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(places, fields=list(item)))
            return of_rows(read_rows, listed.cast(types["defs"]))

        read_rows, counts, scopes, defined = self.reads
        call_rows, callees, enclosings, called = self.calls
        statements, block_pres, block_idxs, followings = self.statements
        is_call = np.zeros(len(codes), bool)
        is_call[call_rows] = True
        is_call = is_call[kept]
        made = {
            "pre": lambda: pa.array(np.array(self.pre, np.int32)[kept]),
            "depth": lambda: pa.array(np.array(self.depth, np.int32)[kept], mask=codes[kept] < 0),
            "node_type": lambda: kinds.take(pa.array(codes[kept], mask=codes[kept] < 0)),
            "name": lambda: of_rows(self.named[0], pa.array(self.named[1], types["name"])),
            "lineno": lambda: pa.array(line[kept], mask=~place),
            "col_offset": lambda: pa.array(col[kept], mask=~place),
            "end_lineno": lambda: pa.array(np.array(self.end, np.int32)[kept], mask=~place),
            **position("parent", lambda: up[kept], lambda rows: rows >= 0),
            **position("encl", lambda: spread(call_rows, enclosings), lambda rows: is_call),
            **position("found", lambda: spread(call_rows, called), lambda rows: rows >= 0),
            "callee": lambda: of_rows(call_rows, pa.array(callees, types["callee"])),
            "defs": definitions,
            "block_pre": lambda: numbers(statements, block_pres),
            "block_idx": lambda: numbers(statements, block_idxs),
            **position("next", lambda: spread(statements, followings), lambda rows: rows >= 0),
        }
        return {name: made[name]() for name in wanted if name in made}


def _parse(record: dict, rows: _Rows) -> tuple:
    """Add the rows of one file, one empty row if it fails; its measures."""

    def failed(kind: str, message: str) -> tuple:
        rows.add_failure()
        return None, None, None, kind, message

    if record["read_error"] is not None:
        return failed(IO_ERROR, record["read_error"])
    if record["text"] is None:
        try:
            (record["bad_content"] or b"").decode("utf-8")
        except UnicodeDecodeError as error:
            return failed(IO_ERROR, str(error))
        return failed(IO_ERROR, "no content")
    try:
        tree = ast.parse(record["text"], filename=record["file_path"])
    except (SyntaxError, RecursionError, MemoryError, ValueError) as error:
        # The last three mean a text too complex for the parser, one file's fault.
        return failed(SYNTAX_ERROR, str(error) or type(error).__name__)
    rows.add_tree(tree)
    return record["file_hash"], record["size_bytes"], record["loc"], None, None


def _record_batch(
    rows: _Rows, units: list[tuple], measures: list[tuple], counts: list[int], wanted: list[str], facts: Iterable[str]
) -> pa.RecordBatch:
    """One Arrow batch of several files; measures go to the first row of each."""
    types = {f.name: f.type for f in to_arrow_schema(schemas.FLAT)}
    kept = rows.holding(facts)
    columns = rows.columns(types, wanted, kept)
    owner = np.repeat(np.arange(len(counts)), counts)[kept]
    first = np.diff(owner, prepend=-1) > 0
    for names, values, index in (
        (_FILE_COLUMNS, units, pa.array(owner)),
        (_MEASURES, measures, pa.array(owner, mask=~first)),
    ):
        for name, column in zip(names, zip(*values)):
            if name not in wanted:
                continue
            columns[name] = pa.array(column, types[name]).take(index)
    return pa.RecordBatch.from_pydict({n: columns[n] for n in wanted})


def _flatten_batches(
    batches: Iterator[pa.RecordBatch], wanted: list[str] = schemas.FLAT.names, facts: Iterable[str] = ()
) -> Iterator[pa.RecordBatch]:
    """Parse with the worker's collector and warnings set aside, and put back however it ends."""
    collecting = gc.isenabled()
    with warnings.catch_warnings():
        # Messages about doubtful escapes in the parsed texts are not ours to print.
        warnings.simplefilter("ignore", SyntaxWarning)
        warnings.simplefilter("ignore", DeprecationWarning)
        # Syntax trees hold no cycles, so searching them for some is wasted time.
        gc.disable()
        try:
            yield from _parsed_batches(batches, wanted, facts)
        finally:
            if collecting:
                gc.enable()


def _parsed_batches(
    batches: Iterator[pa.RecordBatch], wanted: list[str], facts: Iterable[str]
) -> Iterator[pa.RecordBatch]:
    rows, units, measures, counts = _Rows(), [], [], []
    for batch in batches:
        # Texts are large, so they are taken one by one.
        small = {n: batch.column(n).to_pylist() for n in _INPUT if n not in ("text", "bad_content")}
        texts, stray = batch.column("text"), batch.column("bad_content")
        for i in range(batch.num_rows):
            record = {n: values[i] for n, values in small.items()}
            record["text"], record["bad_content"] = texts[i].as_py(), stray[i].as_py()
            before = len(rows)
            measures.append(_parse(record, rows))
            units.append((record["unit"], record["file_path"]))
            counts.append(len(rows) - before)
            if len(rows) >= ROWS_PER_BATCH:
                yield from _slices(_record_batch(rows, units, measures, counts, wanted, facts))
                rows, units, measures, counts = _Rows(), [], [], []
    if len(rows):
        yield from _slices(_record_batch(rows, units, measures, counts, wanted, facts))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch that ends with a very large file leaves the worker in pieces."""
    for start in range(0, batch.num_rows, 2 * ROWS_PER_BATCH):
        yield batch.slice(start, 2 * ROWS_PER_BATCH)


def prepare(sources: DataFrame, wanted: Iterable[str] = _MEASURES) -> DataFrame:
    """Decode, unify newlines and take the ``wanted`` measures, all before Python sees a text.

    ``unit`` tells apart several rows with one path, such as two versions of a
    file in one run. Bytes that are not UTF-8 travel on only for the message.
    """
    raw = F.col("content").cast("string")
    valid = F.is_valid_utf8(raw)
    text = F.col("text")
    measures = {"file_hash": ids.file_hash(text), "size_bytes": ids.size_bytes(text), "loc": ids.line_count(text)}
    return (
        sources.select(
            F.monotonically_increasing_id().alias("unit"),
            "file_path",
            F.when(valid, ids.unix_newlines(raw)).alias("text"),
            F.when(~valid, F.col("content")).alias("bad_content"),
            "read_error",
        )
        .withColumns(
            {n: c if n in wanted else F.lit(None).cast(schemas.FLAT[n].dataType) for n, c in measures.items()}
        )
        .select(*_INPUT)
    )


def flatten(
    sources: DataFrame, columns: Iterable[str] | None = None, facts: Iterable[str] = ()
) -> DataFrame:
    """The syntax table of ``sources`` (see ``schemas.SOURCE``).

    Rows: every node with a position, a ``Module`` row per parsed file, an error
    row per failed file. Filter ``sources`` first: nothing is pushed through the
    parse. Read by several steps, the result belongs in ``session.stage``.

    All rows have the named ``columns`` only, in the schema's order, if some are named: Spark
    cannot see that later steps need no others, and most of a row's cost is its columns. With ``facts``
    (``block_idx``, ``defs``, ``callee``) there are only the rows of nodes that have one of them:
    statements that control flow walks, reads of a defined name, calls.

    Positions stand in for ids, which are hashes of them: small integers store
    and shuffle far better than hex digits, and most rows never need all ids.
    """
    fields = [f for f in schemas.FLAT.fields if columns is None or f.name in set(columns)]
    wanted, facts = [f.name for f in fields], tuple(facts)
    return prepare(sources, wanted).mapInArrow(lambda b: _flatten_batches(b, wanted, facts), StructType(fields))

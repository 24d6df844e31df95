"""Whole modules of the standard library against a direct walk of their trees."""

import ast
import random
from collections import Counter
from pathlib import Path

import pytest

from tests.helpers import ident, parse


@pytest.fixture(scope="module")
def texts():
    folder = Path(ast.__file__).parent
    names = ["ast.py", "asyncio/base_events.py", "contextlib.py", "dataclasses.py", "typing.py",
             "json/decoder.py", "collections/__init__.py", "unittest/mock.py"]
    return {f"lib/{n}": (folder / n).read_text() for n in names}


@pytest.fixture(scope="module")
def parsed(spark, texts):
    return parse(spark, texts)


def place(path, node):
    return ident(path, getattr(node, "lineno", 0), getattr(node, "col_offset", 0), type(node).__name__)


def test_node_counts(parsed, texts):
    got = Counter((r.file_path, r.node_type) for r in parsed.nodes.collect())
    want = Counter(
        (path, type(n).__name__)
        for path, text in texts.items()
        for n in ast.walk(ast.parse(text))
        if hasattr(n, "lineno")
    )
    assert got == want


def test_dataflow(parsed, texts):
    """For each read, look back through the names of each scope around it."""
    want = Counter()
    for path, text in texts.items():
        scopes = [n for n in ast.walk(ast.parse(text))
                  if isinstance(n, (ast.Module, ast.FunctionDef, ast.AsyncFunctionDef))]
        for scope in scopes:
            by_name = {}
            for n in ast.walk(scope):
                if isinstance(n, ast.Name):
                    by_name.setdefault(n.id, []).append(n)
            for same in by_name.values():
                for i, use in enumerate(same):
                    stores = [d for d in same[:i] if isinstance(d.ctx, ast.Store)]
                    if stores and isinstance(use.ctx, ast.Load):
                        want[place(path, stores[-1]), place(path, use)] += 1
    rows = parsed.edges.filter("edge_type = 'DFG'").collect()
    assert Counter((r.source_id, r.target_id) for r in rows) == want


def test_calls(parsed, texts):
    want = Counter(place(path, n) for path, text in texts.items()
                   for n in ast.walk(ast.parse(text)) if isinstance(n, ast.Call))
    rows = parsed.edges.filter("edge_type = 'CALL'").collect()
    assert Counter(r.target_id for r in rows) == want


def test_metadata_adds_up(parsed):
    nodes = Counter(r.file_path for r in parsed.nodes.collect())
    edges = Counter(r.file_path for r in parsed.edges.collect())
    for r in parsed.metadata.collect():
        assert (r.num_nodes, r.num_edges) == (nodes[r.file_path], edges[r.file_path])


def test_order_of_files_does_not_matter(spark, parsed, texts):
    shuffled = list(texts.items())
    random.Random(1).shuffle(shuffled)
    key = lambda p: Counter(r.edge_id for r in p.edges.collect())
    alone = Counter()
    for half in (dict(shuffled[:3]), dict(shuffled[3:])):
        alone += key(parse(spark, half))
    assert alone == key(parsed)


def test_every_edge_ends_at_a_node_or_module(parsed, texts):
    known = {r.node_id for r in parsed.nodes.collect()} | {ident(p, 0, 0, "Module") for p in texts}
    for r in parsed.edges.collect():
        assert r.source_id in known and r.target_id in known

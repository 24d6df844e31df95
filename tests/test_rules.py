"""One small program per rule, with its edges written out by hand."""

import pytest

from tests.helpers import Program, ident, parse, source_rows
from treeloom.operators import derive
from treeloom.operators.flatten import flatten


def test_published_ids(spark):
    from pyspark.sql import functions as F

    from treeloom.functions import ids

    known = [
        ("921b66abda067e3d", "74b0c0b755408ecf", "CFG", "d4f891e8b52d237b"),
        ("c7d8f4c2307abc3e", "102f0b42fd6d6e80", "CFG", "be401114ee23d8b1"),
        ("798721cf0e6eb0b2", "c20a18b766bfaaf5", "CFG", "c455b1a9aa7c09af"),
        ("3dc56c7749d57596", "c85c8f965ab3c65c", "DFG", "33c52f95d901f7d5"),
        ("3400738ab49c1f08", "3c31b0af06a1214b", "DFG", "7b3575fefe399a70"),
        ("9cf4b507dda597f0", "6d22979192bbeefe", "CALL", "abcb82823558c7ff"),
        ("9c1b04a564e9ddc6", "e364f714544c588c", "CALL", "84f84362b3badedd"),
    ]
    rows = spark.createDataFrame(known, "s string, t string, k string, want string")
    got = rows.select("want", ids.edge_id(F.col("s"), F.col("t"), F.col("k")).alias("got"))
    assert all(r.want == r.got for r in got.collect())


def test_node_fields_and_ids(spark):
    p = Program(spark, "class A:\n    async def f(self, x):\n        return x.y\n")
    got = [(n["node_type"], n["name"], n["lineno"], n["col_offset"], n["end_lineno"]) for n in p.nodes]
    assert got == [
        ("ClassDef", "A", 1, 0, 3),
        ("AsyncFunctionDef", "f", 2, 4, 3),
        ("arg", None, 2, 16, 2),
        ("arg", None, 2, 22, 2),
        ("Return", None, 3, 8, 3),
        ("Attribute", "y", 3, 15, 3),
        ("Name", "x", 3, 15, 3),
    ]
    assert p.nodes[0]["node_id"] == ident("repo/m.py", 1, 0, "ClassDef")
    assert p.nodes[0]["parent_id"] is None
    # The list of arguments has no position, so it is nobody's parent.
    assert p.nodes[2]["parent_id"] == p.nodes[1]["node_id"]


def test_unnamed_kinds(spark):
    p = Program(spark, "import a as b\ndef f(c, *, d=1):\n    global g\n    h(k=1)\n")
    unnamed = {n["node_type"] for n in p.nodes if n["name"] is None}
    assert {"Import", "alias", "arg", "Global", "keyword", "Constant"} <= unnamed


def test_equal_starts_share_an_id(spark):
    p = Program(spark, "a.b.c\n")
    outer, inner = [n for n in p.nodes if n["node_type"] == "Attribute"]
    assert outer["node_id"] == inner["node_id"] == inner["parent_id"]
    assert (outer["name"], inner["name"]) == ("c", "b")
    meta = p.parsed.metadata.first()
    assert meta.num_nodes == 4 and len({n["node_id"] for n in p.nodes}) == 3


def test_columns_count_bytes(spark):
    p = Program(spark, "'é'; x\n")
    assert [n["col_offset"] for n in p.nodes if n["node_type"] == "Name"] == [6]


def test_if_has_an_entry_per_branch(spark):
    p = Program(spark, "if a:\n    b\nelif c:\n    d\nelse:\n    e\n")
    assert p.edges("CFG") == [
        ("Module", "If@1:0"),
        ("If@1:0", "Expr@2:4"),
        ("If@1:0", "If@3:0"),
        ("If@3:0", "Expr@4:4"),
        ("If@3:0", "Expr@6:4"),
    ]


def test_chain_comes_before_entry(spark):
    p = Program(spark, "a\nb\nc\n")
    assert p.edges("CFG") == [
        ("Expr@1:0", "Expr@2:0"),
        ("Expr@2:0", "Expr@3:0"),
        ("Module", "Expr@1:0"),
    ]


def test_loops(spark):
    p = Program(spark, "for i in a:\n    b\n    c\nelse:\n    d\nwhile e:\n    f\n")
    assert sorted(p.edges("CFG")) == sorted(
        [
            ("For@1:0", "While@6:0"),
            ("Module", "For@1:0"),
            ("Expr@2:4", "Expr@3:4"),
            ("For@1:0", "Expr@2:4"),
            ("For@1:0", "Expr@5:4"),
            ("While@6:0", "Expr@7:4"),
        ]
    )


def test_handlers_and_cases_are_not_walked(spark):
    text = (
        "try:\n    a\n    b\nexcept E:\n    c\n    if d:\n        e\nelse:\n    f\nfinally:\n    g\n"
        "match h:\n    case 1:\n        i\n        j\n"
    )
    assert sorted(Program(spark, text).edges("CFG")) == sorted(
        [
            ("Try@1:0", "Match@12:0"),
            ("Module", "Try@1:0"),
            ("Expr@2:4", "Expr@3:4"),
            ("Try@1:0", "Expr@2:4"),
            ("Try@1:0", "Expr@9:4"),
            ("Try@1:0", "Expr@11:4"),
        ]
    )


def test_blocks_without_entry(spark):
    text = (
        "with a:\n    b\n    c\n"
        "async def f():\n    async for d in e:\n        g\n        h\n    async with i:\n        j\n        k\n"
        "try:\n    l\n    m\nexcept* E:\n    n\n"
    )
    assert sorted(Program(spark, text).edges("CFG")) == sorted(
        [
            ("With@1:0", "AsyncFunctionDef@4:0"),
            ("AsyncFunctionDef@4:0", "TryStar@11:0"),
            ("Module", "With@1:0"),
            ("Expr@2:4", "Expr@3:4"),
            ("AsyncFor@5:4", "AsyncWith@8:4"),
            ("AsyncFunctionDef@4:0", "AsyncFor@5:4"),
            ("Expr@6:8", "Expr@7:8"),
            ("Expr@9:8", "Expr@10:8"),
            ("Expr@12:4", "Expr@13:4"),
        ]
    )


def test_lambda_and_conditional_bodies_are_no_blocks(spark):
    p = Program(spark, "x = lambda: a\ny = b if c else d\n")
    assert p.edges("CFG") == [("Assign@1:0", "Assign@2:0"), ("Module", "Assign@1:0")]


def test_assignment_feeds_its_own_right_hand_side(spark):
    p = Program(spark, "x = 1\nx = x + 1\n")
    assert p.edges("DFG", "var") == [("Name@2:0", "Name@2:4", "x")]


def test_inner_scope_leaks_into_outer_ones(spark):
    p = Program(spark, "def f():\n    x = 1\n    def g():\n        return x\n")
    assert p.edges("DFG") == [("Name@2:4", "Name@4:15")] * 2


def test_inner_definition_reaches_module_reads(spark):
    # Not nested in reality, but the module's walk sees the function's names.
    p = Program(spark, "def f():\n    x = 1\nprint(a(x))\n")
    assert p.edges("DFG") == [("Name@2:4", "Name@3:8")]


def test_comprehension_targets_lie_deeper(spark):
    assert Program(spark, "[t for t in y]\n").edges("DFG") == []
    p = Program(spark, "[f(g(t)) for t in y]\n")
    assert p.edges("DFG") == [("Name@1:13", "Name@1:5")]


def test_what_is_no_definition(spark):
    text = (
        "import m\ndef f(p):\n    return p\nclass C: pass\n"
        "try:\n    pass\nexcept E as e:\n    e\nmatch 1:\n    case v:\n        v\nm, f, C\ndel q\nq\n"
    )
    assert Program(spark, text).edges("DFG") == []


def test_augmented_and_walrus(spark):
    p = Program(spark, "x = 1\nx += 2\nif (n := x):\n    print(n)\n")
    assert p.edges("DFG", "var") == [
        ("Name@2:0", "Name@3:9", "x"),
        ("Name@3:4", "Name@4:10", "n"),
    ]


def test_calls_belong_to_the_nearest_function(spark):
    p = Program(spark, "@d()\ndef f(a=e(), b: g() = 0) -> h():\n    class C:\n        i()\nj()\n")
    calls = p.edges("CALL", "callee_name")
    assert {(s, n) for s, _, n in calls} == {
        ("FunctionDef@2:0", c) for c in ("d", "e", "g", "h", "i")
    } | {("Module", "j")}


def test_call_without_a_name(spark):
    p = Program(spark, "(lambda: 0)()\nf()()\n")
    assert [n for *_, n in p.edges("CALL", "callee_name")] == [None, None, "f"]
    assert p.edges("CALL_RESOLVES_TO") == []


def test_first_definition_breadth_first_wins(spark):
    text = "class A:\n    def f(self): pass\ndef f(): pass\ndef f(): pass\nf()\no.f()\n"
    assert Program(spark, text).edges("CALL_RESOLVES_TO") == [
        ("Call@5:0", "FunctionDef@3:0"),
        ("Call@6:0", "FunctionDef@3:0"),
    ]


def test_method_resolves_by_bare_name(spark):
    p = Program(spark, "class A:\n    async def m(self): pass\nA().m()\n")
    assert p.edges("CALL_RESOLVES_TO", "callee_name") == [
        ("Call@3:0", "AsyncFunctionDef@2:4", "m")
    ]


@pytest.mark.parametrize("text, loc", [("", 1), ("# only\n# remarks\n", 3), ("x", 1)])
def test_small_files(spark, text, loc):
    meta = parse(spark, {"repo/a.py": text}).metadata.first()
    assert meta.loc == loc and meta.size_bytes == len(text)
    if not text.startswith("x"):
        assert (meta.num_nodes, meta.num_edges) == (0, 0)


def test_newlines_are_unified_before_measuring(spark):
    import hashlib

    meta = parse(spark, {"repo/a.py": b"a = 1\r\nb = 2\rc = 3\n"}).metadata.first()
    unified = b"a = 1\nb = 2\nc = 3\n"
    assert meta.file_hash == hashlib.sha256(unified).hexdigest()
    assert (meta.size_bytes, meta.loc) == (len(unified), 4)


def test_errors(spark):
    parsed = parse(
        spark,
        {
            "repo/ok.py": "x = 1\n",
            "repo/unfinished.py": "def f(:\n",
            "repo/bom.py": b"\xef\xbb\xbfx = 1\n",
            "repo/nul.py": b"x = 1\0\n",
            "repo/latin.py": b"x = 'a'\nb = '\xff'\n",
        },
    )
    errors = {r.file_path: (r.error_type, r.error_message) for r in parsed.errors.collect()}
    assert {p: kind for p, (kind, _) in errors.items()} == {
        "repo/unfinished.py": "syntax_error",
        "repo/bom.py": "syntax_error",
        "repo/nul.py": "syntax_error",
        "repo/latin.py": "io_error",
    }
    assert errors["repo/latin.py"][1] == (
        "'utf-8' codec can't decode byte 0xff in position 13: invalid start byte"
    )
    assert errors["repo/unfinished.py"][1].endswith("(unfinished.py, line 1)")
    # Nothing of a failed file remains.
    assert {r.file_path for r in parsed.nodes.collect()} == {"repo/ok.py"}
    assert [r.file_path for r in parsed.metadata.collect()] == ["repo/ok.py"]


def test_very_deep_text(spark):
    parsed = parse(spark, {"repo/deep.py": "x = " + "(" * 150 + "1" + ")" * 150 + "\n",
                           "repo/long.py": "x = " + " + ".join(["1"] * 3000) + "\n"})
    ok = {r.file_path: r.num_nodes for r in parsed.metadata.collect()}
    failed = {r.file_path: r.error_type for r in parsed.errors.collect()}
    assert ok["repo/deep.py"] == 3
    assert ok.get("repo/long.py") == 2 + 3000 + 2999 or failed["repo/long.py"] == "syntax_error"


def test_two_versions_of_a_path_stay_apart(spark):
    from treeloom import schemas
    from treeloom.plans import batch

    rows = [("repo/a.py", b"x = 1\ny = x\n", None)] * 2 + [("repo/a.py", b"x = 1\n\ny = x\nz = x\n", None)]
    parsed = batch.parse(spark.createDataFrame(rows, schemas.SOURCE))
    per_unit = {
        kind: sorted(r["count"] for r in parsed.edges.filter(f"edge_type = '{kind}'").groupBy("unit").count().collect())
        for kind in ("CFG", "DFG")
    }
    # The second and third line read the x of the first; no edge joins two versions.
    assert per_unit == {"CFG": [2, 2, 3], "DFG": [1, 1, 2]}
    assert sorted(r.num_nodes for r in parsed.metadata.collect()) == [6, 6, 9]


def test_named_columns_alone_leave_the_parser(spark):
    """Steps get the same from the columns they say they read as from all of them."""
    text = "def f(a):\n    b = a\n    if b:\n        return g(b)\n    return f(b)\nf(1)\n"
    texts = source_rows(spark, {"r/a.py": text, "r/b.py": "def f(:\n"})
    whole = flatten(texts)
    for step, columns in (
        (derive.ast_nodes, derive.NODE_COLUMNS), (derive.cfg_edges, derive.CFG_COLUMNS),
        (derive.dfg_edges, derive.DFG_COLUMNS), (derive.call_edges, derive.CALL_COLUMNS),
        (derive.resolve_edges, derive.CALL_COLUMNS), (derive.all_edges, derive.EDGE_COLUMNS),
    ):
        some = flatten(texts, columns)
        assert sorted(some.columns) == sorted(columns)
        got, want = (sorted(str(r) for r in step(table).collect()) for table in (some, whole))
        assert got == want and got

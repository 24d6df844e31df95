"""Expected results in SQL, worked out by hand from the graph rules.

Each program template is described by its nodes, every one with the line and
column at which it must stand given the values filled in, and by its edges as
pairs of nodes. The SQL computes ids from those positions and never parses.
"""

from __future__ import annotations

REPO = "workspace"
T1 = "2024-01-01T00:00:00.000000+00:00"
T2 = "2024-02-01T00:00:00.000000+00:00"


def sid(*parts: str) -> str:
    """SQL of the id over the given SQL parts."""
    return f"substr(sha256(concat_ws(':', {', '.join(parts)})), 1, 16)"


def at(line, col, kind: str) -> str:
    """SQL of a node id at a position in ``src.file``."""
    return sid("file", f"cast({line} as varchar)", f"cast({col} as varchar)", f"'{kind}'")


MODULE = at(0, 0, "Module")


class Template:
    """Nodes and edges of a program, as SQL over the rows of ``src``."""

    def __init__(self, src: str, nodes: list[tuple], edges: list[tuple]):
        # Node: tag, kind, name (SQL or None), line, column, end line, parent tag.
        self.src, self.nodes, self.edges = src, nodes, edges
        self.ids = {tag: at(line, col, kind) for tag, kind, _, line, col, *_ in nodes}
        self.ids["module"] = MODULE

    def node_sql(self) -> str:
        selects = []
        for rank, (tag, kind, name, line, col, end, parent) in enumerate(self.nodes):
            selects.append(
                f"select file as file_path, {self.ids[tag]} as node_id, '{kind}' as node_type,"
                f" {name or 'cast(null as varchar)'} as name, cast({line} as int) as lineno,"
                f" cast({col} as int) as col_offset, cast({end} as int) as end_lineno,"
                f" {self.ids[parent] if parent else 'cast(null as varchar)'} as parent_id,"
                f" {rank} as rank from src"
            )
        return " union all ".join(selects)

    def edge_sql(self, *types: str) -> str:
        selects = []
        for source, target, kind, attr, value in self.edges:
            if types and kind not in types:
                continue
            a, b = self.ids[source], self.ids[target]
            selects.append(
                f"select file as file_path, {a} as source_id, {b} as target_id,"
                f" '{kind}' as edge_type, {sid(a, b, repr(kind))} as edge_id,"
                f" {repr(attr) if attr else 'cast(null as varchar)'} as attr,"
                f" {value or 'cast(null as varchar)'} as attr_value from src"
            )
        return " union all ".join(selects)

    def with_(self, *ctes: str) -> str:
        return ", ".join([f"with src as materialized ({self.src})", *ctes])


# --- routines ---------------------------------------------------------------

_W = "length(k)"
ROUTINES = Template(
    f"""select '{REPO}/routines/' || c_custkey || '.py' as file, cast(c_custkey as varchar) as k,
    c_nationkey as n, c_mktsegment as s, c_acctbal as bal from customer""",
    [
        ("f1", "FunctionDef", "'f_' || k", 2, 0, 6, None),
        ("arg_a", "arg", None, 2, f"7 + {_W}", 2, "f1"),
        ("arg_b", "arg", None, 2, f"10 + {_W}", 2, "f1"),
        ("seed_call", "Call", None, 2, f"12 + {_W}", 2, "f1"),
        ("seed_name", "Name", "'seed'", 2, f"12 + {_W}", 2, "seed_call"),
        ("assign", "Assign", None, 3, 4, 3, "f1"),
        ("t_store", "Name", "'t'", 3, 4, 3, "assign"),
        ("a_load", "Name", "'a'", 3, 8, 3, "assign"),
        ("inner", "FunctionDef", "'inner'", 4, 4, 5, "f1"),
        ("ret_t", "Return", None, 5, 8, 5, "inner"),
        ("t_load", "Name", "'t'", 5, 15, 5, "ret_t"),
        ("ret_inner", "Return", None, 6, 4, 6, "f1"),
        ("inner_call", "Call", None, 6, 11, 6, "ret_inner"),
        ("inner_name", "Name", "'inner'", 6, 11, 6, "inner_call"),
        ("trace_call", "Call", None, 1, 1, 1, "f1"),
        ("trace_name", "Name", "'trace'", 1, 1, 1, "trace_call"),
        ("trace_key", "Constant", None, 1, 7, 1, "trace_call"),
        ("f2", "FunctionDef", "'f_' || k", 7, 0, 8, None),
        ("pass", "Pass", None, 8, 4, 8, "f2"),
        ("class", "ClassDef", "'C_' || n", 9, 0, 11, None),
        ("m", "FunctionDef", "'m'", 10, 4, 11, "class"),
        ("arg_self", "arg", None, 10, 10, 10, "m"),
        ("ret_f", "Return", None, 11, 8, 11, "m"),
        ("f_call", "Call", None, 11, 15, 11, "ret_f"),
        ("f_name", "Name", "'f_' || k", 11, 15, 11, "f_call"),
        ("attr", "Attribute", "s", 11, f"18 + {_W}", 11, "f_call"),
        ("self_name", "Name", "'self'", 11, f"18 + {_W}", 11, "attr"),
        ("expr_m", "Expr", None, 12, 0, 12, None),
        ("m_call", "Call", None, 12, 0, 12, "expr_m"),
        ("m_attr", "Attribute", "'m'", 12, 0, 12, "m_call"),
        ("c_call", "Call", None, 12, 0, 12, "m_attr"),
        ("c_name", "Name", "'C_' || n", 12, 0, 12, "c_call"),
        ("expr_f", "Expr", None, 13, 0, 13, None),
        ("f_call2", "Call", None, 13, 0, 13, "expr_f"),
        ("f_name2", "Name", "'f_' || k", 13, 0, 13, "f_call2"),
        ("f_key", "Constant", None, 13, f"3 + {_W}", 13, "f_call2"),
        ("expr_l", "Expr", None, 14, 0, 14, None),
        ("l_call", "Call", None, 14, 0, 14, "expr_l"),
        ("lambda", "Lambda", None, 14, 1, 14, "l_call"),
        ("zero", "Constant", None, 14, 9, 14, "lambda"),
    ],
    [
        ("f1", "f2", "CFG", None, None),
        ("f2", "class", "CFG", None, None),
        ("class", "expr_m", "CFG", None, None),
        ("expr_m", "expr_f", "CFG", None, None),
        ("expr_f", "expr_l", "CFG", None, None),
        ("module", "f1", "CFG", None, None),
        ("assign", "inner", "CFG", None, None),
        ("inner", "ret_inner", "CFG", None, None),
        ("f1", "assign", "CFG", None, None),
        ("inner", "ret_t", "CFG", None, None),
        ("f2", "pass", "CFG", None, None),
        ("class", "m", "CFG", None, None),
        ("m", "ret_f", "CFG", None, None),
        # Once for the module's scope and once for the outer function's.
        ("t_store", "t_load", "DFG", "var", "'t'"),
        ("t_store", "t_load", "DFG", "var", "'t'"),
        ("f1", "trace_call", "CALL", "callee_name", "'trace'"),
        ("f1", "seed_call", "CALL", "callee_name", "'seed'"),
        ("f1", "inner_call", "CALL", "callee_name", "'inner'"),
        ("m", "f_call", "CALL", "callee_name", "'f_' || k"),
        ("module", "m_call", "CALL", "callee_name", "'m'"),
        ("module", "c_call", "CALL", "callee_name", "'C_' || n"),
        ("module", "f_call2", "CALL", "callee_name", "'f_' || k"),
        ("module", "l_call", "CALL", "callee_name", None),
        ("inner_call", "inner", "CALL_RESOLVES_TO", "callee_name", "'inner'"),
        ("f_call", "f1", "CALL_RESOLVES_TO", "callee_name", "'f_' || k"),
        ("m_call", "m", "CALL_RESOLVES_TO", "callee_name", "'m'"),
        ("f_call2", "f1", "CALL_RESOLVES_TO", "callee_name", "'f_' || k"),
    ],
)

# The same program below one more line, for customers in debt.
MOVED = Template(
    ROUTINES.src + " where c_acctbal < 0",
    [
        (tag, kind, name, line + 1, col, end + 1, parent)
        for tag, kind, name, line, col, end, parent in ROUTINES.nodes
    ],
    ROUTINES.edges,
)

# --- branches: statements and names only, all lines moved down by o ---------

_STATEMENTS = {
    "if1": ("If", 1, 0), "x1": ("Assign", 2, 4), "y1": ("Assign", 3, 4),
    "if4": ("If", 4, 0), "x5": ("Assign", 5, 4), "while7": ("While", 7, 4),
    "x8": ("Assign", 8, 8), "with9": ("With", 9, 4), "read10": ("Expr", 10, 8),
    "close11": ("Expr", 11, 8), "try12": ("Try", 12, 0), "a13": ("Assign", 13, 4),
    "b14": ("Assign", 14, 4), "z19": ("Assign", 19, 4), "w20": ("Assign", 20, 4),
    "match21": ("Match", 21, 0), "g25": ("AsyncFunctionDef", 25, 0),
    "for26": ("AsyncFor", 26, 4), "j27": ("Assign", 27, 8), "k28": ("Assign", 28, 8),
    "p29": ("Assign", 29, 0), "s30": ("Assign", 30, 0), "v31": ("Assign", 31, 0),
}
_CFG = [
    ("if1", "try12"), ("try12", "match21"), ("match21", "g25"), ("g25", "p29"),
    ("p29", "s30"), ("s30", "v31"), ("module", "if1"),
    ("x1", "y1"), ("if1", "x1"), ("if1", "if4"),
    ("if4", "x5"), ("while7", "with9"), ("if4", "while7"),
    ("while7", "x8"), ("read10", "close11"),
    ("a13", "b14"), ("try12", "a13"), ("z19", "w20"), ("try12", "z19"),
    ("g25", "for26"), ("j27", "k28"),
]
_H = "19 + length(k)"
# Name, then line and column of the definition and of the use.
_DFG = [
    ("x", (2, 4), (3, 8)), ("x", (2, 4), (13, 8)), ("a", (13, 4), (14, 8)),
    ("z", (19, 4), (20, 8)), ("x", (5, 4), (7, 10)), ("c", (16, 4), (17, 8)),
    ("m", (23, 8), (24, 12)), ("i", (26, 14), (27, 12)), ("j", (27, 8), (28, 12)),
    ("a", (13, 4), (31, 4)), ("t", (30, 17), (30, 9)), ("x", (8, 8), (8, 12)),
    ("h", (9, _H), (10, 8)), ("h", (9, _H), (11, 8)),
    # Again, for the scope of the function.
    ("i", (26, 14), (27, 12)), ("j", (27, 8), (28, 12)),
]


def _branches() -> Template:
    nodes = [
        (tag, kind, None, f"{line} + o", col, f"{line} + o", None)
        for tag, (kind, line, col) in _STATEMENTS.items()
    ]
    edges = [(a, b, "CFG", None, None) for a, b in _CFG]
    for name, *ends in _DFG:
        tags = [f"{name}@{line}:{col}" for line, col in ends]
        for tag, (line, col) in zip(tags, ends):
            nodes.append((tag, "Name", repr(name), f"{line} + o", col, f"{line} + o", None))
        edges.append((*tags, "DFG", "var", repr(name)))
    src = f"""select '{REPO}/branches/' || o_orderkey || '.py' as file,
    cast(o_orderkey as varchar) as k, cast(left(o_orderpriority, 1) as int) as o from orders"""
    return Template(src, nodes, edges)


BRANCHES = _branches()

# --- ledger: line 1, and lines 2 to p_size + 1 ------------------------------

_LEDGER = f"""with src as materialized (select '{REPO}/ledger/' || p_partkey || '.py' as file, p_size as n from part),
line as (select file, n, unnest(generate_series(1, n + 1)) as l from src)"""

_LEDGER_NODES = " union all ".join(
    f"select file as file_path, {at('l', col, kind)} as node_id, '{kind}' as node_type,"
    f" {name} as name, cast(l as int) as lineno, cast({col} as int) as col_offset,"
    f" cast(l as int) as end_lineno, {parent} as parent_id from line where {where}"
    for col, kind, name, parent, where in [
        (0, "Assign", "cast(null as varchar)", "cast(null as varchar)", "true"),
        (0, "Name", "'total'", at("l", 0, "Assign"), "true"),
        (8, "Constant", "cast(null as varchar)", at("l", 0, "Assign"), "l = 1"),
        (8, "BinOp", "cast(null as varchar)", at("l", 0, "Assign"), "l > 1"),
        (8, "Name", "'total'", at("l", 8, "BinOp"), "l > 1"),
        (16, "Constant", "cast(null as varchar)", at("l", 8, "BinOp"), "l > 1"),
    ]
)


def _edge_columns(a: str, b: str, kind: str) -> str:
    return (
        f"{sid(a, b, repr(kind))} as edge_id, {a} as source_id, {b} as target_id,"
        f" '{kind}' as edge_type, file as file_path"
    )


_LEDGER_CFG = (
    f"select {_edge_columns(at('l', 0, 'Assign'), at('l + 1', 0, 'Assign'), 'CFG')} from line where l <= n"
    f" union all select {_edge_columns(MODULE, at(1, 0, 'Assign'), 'CFG')} from src"
)
# All reads lie deeper than all assignments, so the last assignment feeds each.
_LEDGER_DFG = (
    f"select {_edge_columns(at('n + 1', 0, 'Name'), at('l', 8, 'Name'), 'DFG')},"
    " 'total' as var from line where l > 1"
)
_LEDGER_TEXT = """'total = 0' || chr(10) || list_aggregate(list_transform(generate_series(1, n),
lambda i: 'total = total + ' || i || chr(10)), 'string_agg', '')"""

# Listing of the ledgers as a source tree.
_LISTING = """with part_src as (
  select *, p_size as n, replace(p_brand, '#', '_') as brand, p_size % 10 as d,
    case when p_type = 'ECONOMY' then 'tests' when p_type = 'PROMO' then 'test'
      when p_size = 49 then '.git' else lower(p_type) end as folder from part),
entry as (
  select case when n = 45 then 'root_' || p_partkey || '.py' when n = 46 then
    brand || '/' || folder || '/p' || p_partkey || '.py' else
    brand || case when p_partkey % 3 = 0 then '-x' else '' end || '/' || folder
    || '/p' || p_partkey || '/' || case d when 0 then 'setup.py' when 1 then 'conf.py'
      when 2 then 'test_ledger.py' when 3 then 'ledger_test.py' when 4 then 'latest.py'
      else 'ledger_' || p_partkey || '.py' end end as rel_path,
    cast(10 + 16 * n + list_sum(list_transform(generate_series(1, n), lambda i: length(cast(i as varchar)) + 1)) as bigint)
      as size_bytes,
    n, d, p_type from part_src),
listing as (
  select rel_path, size_bytes,
    n <> 45 and (d <= 3 or p_type in ('ECONOMY', 'PROMO')) as excluded
  from entry where not (n = 49 and p_type not in ('ECONOMY', 'PROMO')))"""


# --- sources with known measures ---------------------------------------------

_ROUTINES_TEXT = """'@trace(<key>)
def f_<key>(a, b=seed()):
    t = a
    def inner():
        return t
    return inner()
def f_<key>():
    pass
class C_<nation>:
    def m(self):
        return f_<key>(self.<segment>)
C_<nation>().m()
f_<key>(<key>)
(lambda: 0)()
'"""
_ROUTINES_FILLED = (
    f"replace(replace(replace({_ROUTINES_TEXT}, '<key>', k), '<nation>', cast(n as varchar)), '<segment>', s)"
)
# Per file: functions, classes, nodes and edges of the routines template.
_ROUTINES_COUNTS = (4, 1, len(ROUTINES.nodes), len(ROUTINES.edges))

# One row per run of a file: all in the first, those in debt again in the second.
_RUNS = f"""run as (
  select file, k, '{T1}' as event_time, 1704067200.0 as epoch, {_ROUTINES_FILLED} as text, 1 as run from src
  union all
  select file, k, '{T2}', 1706745600.0, {_ROUTINES_FILLED} || '# in debt' || chr(10), 2 from src where bal < 0)"""
_NODE = f"node as ({ROUTINES.node_sql()})"
_EDGE = f"edge as ({ROUTINES.edge_sql()})"

_HASH = """sha256(text) as file_hash, cast(strlen(text) as bigint) as size_bytes,
  cast(length(text) - length(replace(text, chr(10), '')) + 1 as bigint) as loc"""


def _counts(functions, classes, nodes, edges) -> str:
    return (
        f"cast({functions} as bigint) as num_functions, cast({classes} as bigint) as num_classes,"
        f" cast({nodes} as bigint) as num_nodes, cast({edges} as bigint) as num_edges"
    )


_DOCUMENT = f"""select file as _id, '1.0' as schema_version, event_time, 'metadata' as event_type,
  {_HASH}, {_counts(*_ROUTINES_COUNTS)}, run from run"""
_LATEST_DOCUMENT = f"""{ROUTINES.with_(_RUNS, f"doc as ({_DOCUMENT})")}
select * exclude (run) from doc qualify row_number() over (partition by _id order by run desc) = 1"""

_VERTEX = f"""vertex as (
  select node_id as id, file_path, node_type, name, lineno, col_offset, end_lineno, parent_id,
    '1.0' as schema_version, case when bal < 0 then '{T2}' else '{T1}' end as event_time
  from (select * from node qualify row_number() over (partition by node_id order by rank desc) = 1)
    join src on file = file_path
  union all
  select {MODULE}, null, null, null, null, null, null, null, null, null from src)"""
_REL = f"""rel as (
  select distinct parent_id as src, node_id as dst, 'PARENT_OF' as type,
    cast(null as varchar) as edge_id, cast(null as varchar) as file_path, cast(null as varchar) as event_time
  from node where parent_id is not null
  union all
  select distinct source_id, target_id, edge_type, edge_id, file_path,
    case when bal < 0 then '{T2}' else '{T1}' end
  from edge join src on file = file_path)"""
_GRAPH = ROUTINES.with_(_NODE, _EDGE, _VERTEX, _REL)


def _paths(head: str, rel_type: str, where: str, hops: int, tail: str = "") -> str:
    """Paths of one to ``hops`` steps by plain joins, no step taken twice."""
    selects = []
    for n in range(1, hops + 1):
        joins = [f"vertex v join step e1 on e1.src = v.id"]
        joins += [f"join step e{i} on e{i}.src = e{i - 1}.dst" for i in range(2, n + 1)]
        apart = [
            f"(e{i}.src, e{i}.dst) <> (e{j}.src, e{j}.dst)"
            for i in range(1, n + 1)
            for j in range(1, i)
        ]
        walked = " || '>' || ".join(["v.id", *[f"e{i}.dst" for i in range(1, n + 1)]])
        selects.append(
            f"select {n} as hops, v.id as start_id, e{n}.dst as end_id, {walked} as path"
            f" from {' '.join(joins)} where {' and '.join([where, *apart])}"
        )
    step = f"step as (select src, dst from rel where type = '{rel_type}')"
    return f"{head}, {step} select * from ({' union all '.join(selects)}) {tail}"


def oracle_sql() -> dict[str, str]:
    edge_columns = "edge_id, source_id, target_id, edge_type, file_path"
    routine_edges = lambda kind, attr: (
        f"{ROUTINES.with_(f'edge as ({ROUTINES.edge_sql(kind)})')}"
        f" select {edge_columns}{f', attr_value as {attr}' if attr else ''} from edge"
    )
    branch_edges = lambda kind, attr: (
        f"{BRANCHES.with_(f'edge as ({BRANCHES.edge_sql(kind)})')}"
        f" select {edge_columns}{f', attr_value as {attr}' if attr else ''} from edge"
    )
    top_dirs = """select split_part(rel_path, '/', 1) as top_dir, count(*) as files,
      min(string_split(rel_path, '/')) as first_path from listing group by 1"""
    ledger_counts = _counts(0, 0, "3 + 5 * n", "2 * n + 1")
    ledger_meta = f"{_LEDGER}, doc as (select file, n, {_LEDGER_TEXT} as text from src)"
    quoted = f"""with doc as (select '{REPO}/quoted/' || doc_id || '.py' as file,
      'doc = ' || doc_id || chr(10) || '# ' || replace(text, chr(10), chr(10) || '# ') as text from documents)"""
    event_head = "'1.0' as schema_version, event_time"
    expected = {
        "discovery_listing": f"{_LISTING} select *, split_part(rel_path, '/', 1) as top_dir from listing",
        "discovery_totals": f"""{_LISTING} select count(*) as total_py_files,
          count(*) filter (where not excluded) as included_files,
          count(*) filter (where excluded) as excluded_files,
          cast(sum(size_bytes) as bigint) as total_size_bytes from listing""",
        "discovery_top_dirs": f"{_LISTING} select top_dir, files from ({top_dirs}) order by files desc, first_path",
        "discovery_largest": f"{_LISTING} select * from listing order by size_bytes desc, string_split(rel_path, '/') limit 5",
        "discovery_first_per_flag": f"""{_LISTING} select rel_path, size_bytes, excluded,
          cast(row_number() over (partition by excluded order by string_split(rel_path, '/')) as int) as position,
          case when excluded then case when contains(lower(rel_path), 'test') then '[test dir]'
            else '[name match]' end end as reason
          from listing qualify position <= 5""",
        "discovery_summary": f"""{_LISTING}
          select 'top_dirs' as part, top_dir as item, files as amount from ({top_dirs})
          union all
          select 'largest', rel_path, size_bytes
            from (select * from listing order by size_bytes desc, string_split(rel_path, '/') limit 5)
          union all select 'totals', 'files', count(*) from listing
          union all select 'totals', 'bytes', cast(sum(size_bytes) as bigint) from listing""",
        "exclusion_reasons": f"""{_LISTING} select rel_path, excluded,
          case when contains(lower(rel_path), 'test') then '[test dir]' else '[name match]' end as reason,
          case when length(rel_path) > 24 then '...' || right(rel_path, 21) else rel_path end as short_path
          from listing""",
        "target_files": f"{_LISTING} select * from listing where not excluded order by string_split(rel_path, '/') limit 50",
        "target_files_all": f"{_LISTING} select * from listing where not excluded",
        "single_target": f"{_LISTING} select * from listing where rel_path = (select max(rel_path) from listing)",
        "ast_nodes": f"{_LEDGER} {_LEDGER_NODES}",
        "ast_nodes_nested": f"{ROUTINES.with_(_NODE)} select * exclude (rank) from node",
        "cfg_edges": f"{_LEDGER} {_LEDGER_CFG}",
        "cfg_edges_branches": branch_edges("CFG", None),
        "cfg_edges_nested": routine_edges("CFG", None),
        "dfg_edges": f"{_LEDGER} {_LEDGER_DFG}",
        "dfg_edges_branches": branch_edges("DFG", "var"),
        "dfg_edges_scopes": routine_edges("DFG", "var"),
        "call_edges": routine_edges("CALL", "callee_name"),
        "call_resolves": routine_edges("CALL_RESOLVES_TO", "callee_name"),
        "edge_union": f"{ROUTINES.with_(_EDGE)} select {edge_columns} from edge",
        "edge_counts": f"""{BRANCHES.with_()} select file as file_path,
          cast({len(_CFG)} as bigint) as num_cfg_edges, cast({len(_DFG)} as bigint) as num_dfg_edges,
          cast(3 + 2 as bigint) as num_call_edges,
          cast({len(_CFG)} + {len(_DFG)} + 3 + 2 as bigint) as num_total_edges from src""",
        "file_metadata": f"{ledger_meta} select file as file_path, {_HASH}, {ledger_counts} from doc",
        "file_metadata_calls": f"""{ROUTINES.with_(_RUNS)} select file as file_path, {_HASH},
          {_counts(*_ROUTINES_COUNTS)} from run where run = 1""",
        "file_metadata_texts": f"{quoted} select file as file_path, {_HASH}, {_counts(0, 0, 3, 1)} from doc",
        "parse_errors": f"""select '{REPO}/prose/' || doc_id || '.py' as file_path,
          case when lang = 'fr' then 'io_error' else 'syntax_error' end as error_type from documents""",
        "run_summary": """select count(*) as files_ok, count(*) as files_failed,
          3 * count(*) as total_nodes, count(*) as total_edges from documents""",
        "run_rates": """with t as (select count(*) as files_ok, cast(0 as bigint) as files_failed,
            cast(sum(3 + 5 * p_size) as bigint) as total_nodes,
            cast(sum(2 * p_size + 1) as bigint) as total_edges from part)
          select *, round(files_ok / (files_ok / 100), 1) as files_per_second,
            round(total_nodes / files_ok, 1) as nodes_per_file,
            round(total_edges / files_ok, 1) as edges_per_file, 100.0::double as parsed_percent from t""",
        "batch_table": f"""{ledger_meta}, m as (select file as file_path, {_HASH}, {ledger_counts} from doc)
          select file_path, file_path as short_path, loc, num_functions, num_classes, num_nodes, num_edges,
            case when num_nodes + num_edges < 50 then 'very low' when num_nodes + num_edges < 200 then 'low'
              when num_nodes + num_edges < 600 then 'medium' else 'high' end as complexity from m""",
        "samples": f"""{ROUTINES.with_()} select file as file_path, {ROUTINES.ids['f1']} as node_id,
          'FunctionDef' as node_type, 'f_' || k as name,
          {sid(ROUTINES.ids['f1'], ROUTINES.ids['f2'], "'CFG'")} as cfg_edge_id,
          {sid(ROUTINES.ids['t_store'], ROUTINES.ids['t_load'], "'DFG'")} as dfg_edge_id,
          {sid(ROUTINES.ids['f1'], ROUTINES.ids['seed_call'], "'CALL'")} as call_edge_id from src""",
        "manifest_upsert": f"""{ROUTINES.with_(_RUNS)} select replace(file, '{REPO}/', '') as rel_path,
          sha256(text) as file_hash, cast({_ROUTINES_COUNTS[2]} as bigint) as num_nodes,
          cast({_ROUTINES_COUNTS[3]} as bigint) as num_edges, epoch::double as last_processed
          from run qualify row_number() over (partition by file order by run desc) = 1""",
        "manifest_saved": f"""{ROUTINES.with_(_RUNS)} select replace(file, '{REPO}/', '') as rel_path,
          sha256(text) as file_hash, cast({_ROUTINES_COUNTS[2]} as bigint) as num_nodes,
          cast({_ROUTINES_COUNTS[3]} as bigint) as num_edges, epoch::double as last_processed
          from run qualify row_number() over (partition by file order by run desc) = 1""",
        "incremental_run": f"""{ROUTINES.with_(_RUNS)} select replace(file, '{REPO}/', '') as rel_path,
          sha256(text) as file_hash, cast({_ROUTINES_COUNTS[2]} as bigint) as num_nodes,
          cast({_ROUTINES_COUNTS[3]} as bigint) as num_edges, epoch::double as last_processed, run as parses
          from run qualify row_number() over (partition by file order by run desc) = 1""",
        "manifest_scan": f"{_LISTING} select *, split_part(rel_path, '/', 1) as top_dir from listing",
        "node_events": f"""{ROUTINES.with_(_RUNS, _NODE)} select {event_head}, 'node' as event_type,
          node.* exclude (rank) from node join run on file = file_path""",
        "edge_events": f"""{ROUTINES.with_(_RUNS, _EDGE)} select {event_head}, 'edge' as event_type, {edge_columns},
          case when attr is null then 0 else 1 end as num_attrs, attr_value
          from edge join run on file = file_path""",
        "metadata_events": f"{ROUTINES.with_(_RUNS)} select * exclude (run) from ({_DOCUMENT})",
        "error_events": f"""select '1.0' as schema_version, '{T1}' as event_time, 'error' as event_type,
          '{REPO}/prose/' || doc_id || '.py' as file_path,
          case when lang = 'fr' then 'io_error' else 'syntax_error' end as error_type from documents""",
        "event_keys": f"""{ROUTINES.with_(_RUNS, _NODE, _EDGE)}, log as (
            select 'cpg.nodes' as topic, node_id as key from node join run on file = file_path
            union all select 'cpg.edges', edge_id from edge join run on file = file_path
            union all select 'cpg.metadata', file from run)
          select topic, key, count(*) as events, cast(1 as bigint) as partitions,
            cast(1 as bigint) as keys_in_text from log group by 1, 2""",
        "topic_counts": f"""{ROUTINES.with_(_RUNS)}, c as (select count(*) as c from run), t as (
            select 'cpg.nodes' as topic, 3 as partitions, c * {_ROUTINES_COUNTS[2]} as messages from c
            union all select 'cpg.edges', 3, c * {_ROUTINES_COUNTS[3]} from c
            union all select 'cpg.metadata', 1, c from c union all select 'cpg.errors', 1, 0)
          select * from t union all select 'TOTAL', cast(sum(partitions) as int), cast(sum(messages) as bigint) from t""",
        "consumer_lag": f"""{ROUTINES.with_(_RUNS, _NODE)}, log as (
            select run, cast(('0x' || substr(sha256(node_id), 1, 8))::ubigint % 3 as int) as partition
            from node join run on file = file_path),
          p as (select partition, count(*) filter (where run = 1) as current_offset, count(*) as log_end
            from log group by 1),
          t as (select * from p union all
            select null, cast(sum(current_offset) as bigint), cast(sum(log_end) as bigint) from p)
          select *, log_end - current_offset as lag, round(current_offset * 100 / log_end, 1) as progress from t""",
        "end_to_end_run": f"""{ROUTINES.with_(_RUNS)}, r as (select * from run where run = 1),
          c as (select count(*) as c, {_ROUTINES_COUNTS[2]} as n, {_ROUTINES_COUNTS[3]} as e from r)
          select 'topic' as part, 'cpg.nodes' as item, cast(c * n as bigint) as amount from c
          union all select 'topic', 'cpg.edges', c * e from c
          union all select 'topic', 'cpg.metadata', c from c
          union all select 'topic', 'cpg.errors', 0
          union all select 'topic', 'TOTAL', c * (n + e + 1) from c
          union all select 'summary', 'files_ok', c from c
          union all select 'summary', 'files_failed', 0
          union all select 'summary', 'total_nodes', c * n from c
          union all select 'summary', 'total_edges', c * e from c
          union all select 'written', 'files', c from c
          union all select 'file', replace(file, '{REPO}/', '') || ' ' || sha256(text), {_ROUTINES_COUNTS[2]} from r""",
        "vertices": f"{_GRAPH} select * from vertex",
        "relationships": f"{_GRAPH} select * from rel",
        "stub_vertices": f"{ROUTINES.with_()} select {MODULE} as id from src",
        "unknown_edge_types": """select 'vertex' as part, id, cast(null as varchar) as other
            from (select 'c' || o_custkey as id from orders union select 'o' || o_orderkey from orders)
          union all select distinct 'CALL', 'c' || o_custkey, 'o' || o_orderkey from orders where o_orderstatus = 'F'""",
        "vertex_merge": """select 'o' || l_orderkey as id, nullif(l_returnflag, 'N') as flag,
            nullif(l_linestatus, 'O') as status from lineitem
          qualify row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc,
            l_partkey desc, l_suppkey desc, floor(l_extendedprice * 100) desc) = 1""",
        "relationship_merge": """select 's' || l_suppkey as src, 'p' || l_partkey as dst, 'CALL' as type,
            'e' || l_orderkey as edge_id, cast(l_linenumber as varchar) as event_time from lineitem
          qualify row_number() over (partition by l_suppkey, l_partkey order by l_shipdate desc,
            l_orderkey desc, l_linenumber desc, floor(l_extendedprice * 100) desc) = 1""",
        "moved_vertices": f"""with src as materialized ({ROUTINES.src}), node as (
            select *, '{T1}' as event_time from ({ROUTINES.node_sql()})
            union all
            select *, '{T2}' as event_time from (with src as ({MOVED.src}) {MOVED.node_sql()}))
          select node_id as id, file_path, node_type, name, lineno, col_offset, end_lineno, parent_id,
            '1.0' as schema_version, event_time from node
          qualify row_number() over (partition by node_id order by event_time desc, rank desc) = 1
          union all
          select {MODULE}, null, null, null, null, null, null, null, null, null from src""",
        "current_vertices": f"""with src as materialized ({ROUTINES.src}), node as (
            select * exclude (bal), '{T1}' as event_time from ({ROUTINES.node_sql()})
              join (select file as file_path, bal from src) using (file_path) where bal >= 0
            union all
            select *, '{T2}' as event_time from (with src as ({MOVED.src}) {MOVED.node_sql()}))
          select node_id as id, file_path, node_type, name, lineno, col_offset, end_lineno, parent_id,
            '1.0' as schema_version, event_time from node
          qualify row_number() over (partition by node_id order by event_time desc, rank desc) = 1
          union all
          select {MODULE}, null, null, null, null, null, null, null, null, null from src""",
        "current_relationships": f"""with src as materialized ({ROUTINES.src}), node as (
            select parent_id, node_id from ({ROUTINES.node_sql()})
              join (select file as file_path, bal from src) using (file_path) where bal >= 0
            union all
            select parent_id, node_id from (with src as ({MOVED.src}) {MOVED.node_sql()})),
          edge as (
            select source_id, target_id, edge_type, edge_id, file_path, '{T1}' as event_time from ({ROUTINES.edge_sql()})
              join (select file as file_path, bal from src) using (file_path) where bal >= 0
            union all
            select source_id, target_id, edge_type, edge_id, file_path, '{T2}'
              from (with src as ({MOVED.src}) {MOVED.edge_sql()}))
          select distinct parent_id as src, node_id as dst, 'PARENT_OF' as type, cast(null as varchar) as edge_id,
            cast(null as varchar) as file_path, cast(null as varchar) as event_time
          from node where parent_id is not null
          union all
          select distinct source_id, target_id, edge_type, edge_id, file_path, event_time from edge""",
        "relationship_counts": f"""{_GRAPH} select type, count(*) as relationships from rel group by 1
          union all select null, count(*) from rel""",
        "graph_totals": f"""{_GRAPH} select count(*) as vertices,
          count(*) filter (where node_type is null) as stubs, count(distinct file_path) as files from vertex""",
        "type_histogram": f"""{_GRAPH} select node_type, count(*) as vertices from vertex
          where node_type is not null group by 1 order by 2 desc, 1 limit 10""",
        "type_histogram_with_null": f"""{_GRAPH} select node_type, count(*) as vertices from vertex
          group by 1 order by 2 desc, 1 nulls first limit 30""",
        "node_type_counts": f"""{_LEDGER}, node as ({_LEDGER_NODES}) select node_type, count(*) as events
          from node group by 1 order by 2 desc, 1 limit 10""",
        "named_definitions": f"""{_GRAPH} select name, file_path, lineno from vertex
          where node_type = 'FunctionDef' and name is not null order by file_path, lineno, name limit 8""",
        "named_definitions_all": f"""{_GRAPH} select name, file_path, lineno from vertex
          where node_type = 'FunctionDef' and name is not null""",
        "call_paths": _paths(_GRAPH, "CALL", "v.name = 'm'", 2),
        "call_paths_first": _paths(_GRAPH, "CALL", "v.name = 'm'", 2, "order by hops, path limit 50"),
        "subtree_paths": _paths(_GRAPH, "PARENT_OF", "v.file_path is not null", 3),
        "subtree_paths_first": _paths(
            _GRAPH, "PARENT_OF", f"v.file_path = '{REPO}/routines/0.py'", 3, "order by hops, path limit 100"
        ),
        "dataflow_paths": _paths(_GRAPH, "DFG", "v.file_path is not null", 1),
        "dataflow_paths_first": _paths(
            _GRAPH, "DFG", "contains(v.file_path, '/routines/0.py')", 1, "order by hops, path limit 30"
        ),
        "region_paths": _paths(
            """with vertex as (select 'r' || r_regionkey as id from region), rel as (
              select 'r' || n_regionkey as src, 'n' || n_nationkey as dst, 'PARENT_OF' as type from nation
              union all select 'n' || c_nationkey, 'c' || c_custkey, 'PARENT_OF' from customer
              union all select 'c' || o_custkey, 'o' || o_orderkey, 'PARENT_OF' from orders)""",
            "PARENT_OF",
            "true",
            3,
        ),
        "stream_documents": _LATEST_DOCUMENT,
        "document_by_id": f"{_LATEST_DOCUMENT} and _id = '{REPO}/routines/0.py'",
        "stream_rejects": f"""select 'document' as part, '{REPO}/routines/' || c_custkey || '.py' as item from customer
          union all select 'reject', sha256(text) from documents""",
        "stream_graph_rejects": f"""{_GRAPH} select 'vertex' as part, id as item from vertex
          union all select 'nodes', sha256(text) from documents
          union all select 'edges', sha256(text) from documents""",
        "continuous_documents": _LATEST_DOCUMENT,
        "concurrent_documents": _LATEST_DOCUMENT,
        "concurrent_vertices": f"{_GRAPH} select * from vertex",
        "offset_order": f"""select 'u' || user_id as _id, sha256(arg_max(event_type, event_id)) as file_hash,
          max(event_id) as loc, '{T1}' as event_time from events group by user_id""",
        "stream_errors": f"""select '{REPO}/prose/' || doc_id || '.py' as file_path,
          case when lang = 'fr' then 'io_error' else 'syntax_error' end as error_type, '{T1}' as event_time,
          case when lang = 'de' then '{T2}' end as closed_time from documents""",
        "stream_resume": """select cast(0 as bigint) as batch_id, count(*) as input_rows from customer
          union all select 1, count(*) from customer where c_acctbal < 0""",
        "stream_resumed_documents": _LATEST_DOCUMENT,
        "replay_counts": """select count(*) as documents_before, count(*) as documents_after,
          count(*) filter (where c_acctbal < 0) as changed,
          cast(count(*) filter (where c_acctbal < 0) as bigint) as lines_added from customer""",
        "stream_vertices": f"{_GRAPH} select * from vertex",
        "stream_relationships": f"{_GRAPH} select * from rel",
    }
    totals = {
        "totals": ("discovery_totals", "'files'", "total_py_files"),
        "top_dirs": ("discovery_top_dirs", "top_dir", "files"),
        "largest": ("discovery_largest", "rel_path", "size_bytes"),
        "topics": ("topic_counts", "topic", "messages"),
        "lag": ("consumer_lag", "cast(partition as varchar)", "lag"),
        "graph": ("graph_totals", "'stubs'", "stubs"),
        "relationships": ("relationship_counts", "type", "relationships"),
    }
    parts = [
        f"select '{part}' as part, {item} as item, cast({amount} as bigint) as amount from ({expected[name]})"
        for part, (name, item, amount) in totals.items()
    ]
    for part, amount in (("files", len(ROUTINES.nodes)), ("edges_per_file", len(ROUTINES.edges)), ("samples", 2)):
        parts.append(f"select '{part}', '{REPO}/routines/' || c_custkey || '.py', {amount} from customer")
    parts.append(
        f"select 'types', * from ({_GRAPH} select node_type, count(*) from vertex group by 1"
        " order by count(*) desc, node_type nulls first limit 10)"
    )
    return expected | {"report_dataset": " union all ".join(parts)}

"""Several targets over one source.

The warehouse ran one MERGE per target, each scanning the source.  Here the
targets form a lattice.  A target whose measures are mergeable (SUM, COUNT,
MIN, MAX, AVG) keeps them as partial states; another whose keys all follow
from the keys of the first is rolled up from these states instead of from
the rows, so the source is shuffled once per finest set.  The row-pattern
key follows when the coarser mask holds all bits of the finer one, as
``(p | fine) | coarse = p | coarse``.  A target with a measure that cannot be
merged (COUNT DISTINCT, free expressions) is aggregated on its own, so its
distinct values never multiply the rows of the others.

A parent's states, both an answer and the input of its children, are written
once to the shared folder.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..specs import SourceSpec, TargetSpec
from .aggregate import aggregate_exprs, key_exprs, plan_source
from .joins import measured

# One mergeable aggregate call within a template; the rest of the template is
# applied to its result.
_CALL = re.compile(r"\b(SUM|COUNT|MIN|MAX|AVG)\(\s*(\?|\*)\s*\)", re.IGNORECASE)
_ANY_CALL = re.compile(r"\b(?!ROUND\b|COALESCE\b|ABS\b|CAST\b|NULLIF\b)[A-Za-z_]+\s*\(", re.IGNORECASE)


@dataclass
class _Measure:
    """A mergeable template: states, and the measure from the merged states."""
    call: str
    source: str
    template: str
    type: T.DataType          # of the template over rows
    inner: T.DataType         # of the aggregate call alone

    @property
    def states(self) -> list[tuple[str, str]]:
        """(kind, source column) of each state."""
        src = "" if self.call == "COUNT" and self.source == "*" else self.source
        return {"AVG": [("sum", src), ("count", src)]}.get(self.call, [(self.call.lower(), src)])

    def value(self) -> Column:
        s = [F.col(_state(*x)) for x in self.states]
        if self.call == "AVG":
            wide = s[0] if isinstance(self.inner, T.DecimalType) else s[0].cast("double")
            many = s[1].cast("decimal(20,0)") if isinstance(self.inner, T.DecimalType) else s[1]
            inner = F.try_divide(wide, many).cast(self.inner)
        else:
            inner = s[0].cast(self.inner)
        before, after = _CALL.split(self.template, maxsplit=1)[::3]
        if not before.strip() and not after.strip():
            return inner.cast(self.type)
        one = F.array(F.struct(inner.alias("m")))
        return F.get(F.call_function("transform", one, F.expr(f"q -> {before}q.m{after}")), F.lit(0)).cast(self.type)


def _state(kind: str, source: str) -> str:
    return f"_rw_{kind}_{source}"


@dataclass
class _Node:
    target: TargetSpec
    name: str
    keys: dict[str, tuple[str, int | None]]   # target dim -> (source column, mask of the pattern key)
    exprs: list[Column]
    measures: dict[str, _Measure] | None      # None: not mergeable
    parent: "_Node | None" = None
    states: set[tuple[str, str]] = field(default_factory=set)
    frame: DataFrame | None = None


def _mergeable(df: DataFrame, target: TargetSpec) -> dict[str, _Measure] | None:
    out = {}
    for tgt, src, tpl in zip(*target.measures, target.aggregate_functions):
        if not isinstance(tpl, str) or len(_CALL.findall(tpl)) != 1 or _ANY_CALL.search(_CALL.sub("m", tpl)):
            return None
        call, arg = _CALL.search(tpl).groups()
        call = call.upper()
        one = f"{call}({'*' if arg == '*' else f'`{src}`'})"
        types = df.limit(0).agg(F.expr(tpl.replace("?", f"`{src}`", 1)).alias("t"), F.expr(one).alias("i")).schema
        out[tgt] = _Measure(call, "*" if arg == "*" else src, tpl, types["t"].dataType, types["i"].dataType)
    return out


def _follows(child: _Node, parent: _Node) -> bool:
    """Whether the child's keys are functions of the parent's."""
    if child.target.blank_as_null != parent.target.blank_as_null:
        return False
    have = {src: mask for src, mask in parent.keys.values()}
    return all(src in have and (mask is None or (have[src] | mask) == mask) for src, mask in child.keys.values())


def _aggregated(df: DataFrame, node: _Node) -> DataFrame:
    """The node's keys and states: from its parent's states, or from rows."""
    kinds = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    if node.parent is not None:
        dim = {src: d for d, (src, _) in node.parent.keys.items()}
        keys = [(F.col(dim[src]).bitwiseOR(F.lit(mask)) if mask is not None else F.col(dim[src])).alias(d)
                for d, (src, mask) in node.keys.items()]
        return node.parent.frame.groupBy(*keys).agg(*[kinds[k](_state(k, s)).alias(_state(k, s)) for k, s in sorted(node.states)])
    over = {"sum": F.sum, "count": lambda c: F.count(c if c != "" else F.lit(1)), "min": F.min, "max": F.max}
    return df.groupBy(*node.exprs).agg(*[over[k](s).alias(_state(k, s)) for k, s in sorted(node.states)])


def lattice(df: DataFrame, targets: list[TargetSpec], source: SourceSpec, names: list[str] | None = None) -> list[_Node]:
    """The targets with their parents, finest first."""
    nodes = []
    for t, name in zip(targets, names or [t.target_table for t in targets]):
        plan = plan_source(t, source)
        keys = {d: (s, plan.effective_mask if s == t.row_pattern_column else None) for d, s in plan.kept}
        nodes.append(_Node(t, name, keys, key_exprs(df, t, plan), _mergeable(df, t)))
    merge = sorted((n for n in nodes if n.measures is not None), key=lambda n: -len(n.keys))
    for i, n in enumerate(merge):
        fit = [p for p in merge[:i] if _follows(n, p)]
        n.parent = min(fit, key=lambda p: len(p.keys), default=None)
        n.states = {s for m in n.measures.values() for s in m.states}
    for n in reversed(merge):  # a parent carries what its children need
        if n.parent is not None:
            n.parent.states |= n.states
    return merge + [n for n in nodes if n.measures is None]


def rollup_targets(df: DataFrame, targets: list[TargetSpec], source: SourceSpec,
                   names: list[str] | None = None) -> DataFrame:
    """Aggregate ``df`` for every target.

    Returns one table: ``target_table`` plus the union of the targets' dims
    and measures; dims and measures a target does not have are NULL."""
    dims = list(dict.fromkeys(d for t in targets for d in t.dims[0]))
    measures = list(dict.fromkeys(m for t in targets for m in t.measures[0]))
    parts, kept = {}, set()
    nodes = lattice(df, targets, source, names)
    for n in nodes:
        if n.measures is None:
            rows = df.groupBy(*n.exprs).agg(*aggregate_exprs(n.target))
            values = {m: F.col(m) for m in n.target.measures[0]}
        else:
            rows = n.frame = _aggregated(df, n)
            if any(c.parent is n for c in nodes):  # an answer and an input: written, so it runs once
                rows = n.frame = measured(rows, "states")
            values = {m: x.value() for m, x in n.measures.items()}
        kept |= set(n.keys)
        parts[n.name] = rows.select(F.lit(n.name).alias("target_table"), *n.keys, *[v.alias(m) for m, v in values.items()])
    order = ["target_table", *[d for d in dims if d in kept], *measures]
    out = None
    for name in names or [t.target_table for t in targets]:
        out = parts[name] if out is None else out.unionByName(parts[name], allowMissingColumns=True)
    return out.select(*order)

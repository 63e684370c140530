"""Data contracts (YAML text or dict) -> checks.  Driver-side glue only.

Three dialects load into one form: models as a dict or a list, fields as a
dict or a list (``fields`` / ``properties``), quality at field or model level,
``references`` or ``rule: referential_integrity``, ``servicelevels`` or
``serviceLevel``.  Each declared rule becomes a ``ContractRule`` holding a
``Check`` or, when it cannot be evaluated (text we do not understand, a
parent table outside the contract, freshness without a timestamp field), a
``SKIPPED`` status with the reason -- never a silent PASS.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace, replace
from typing import Any

from probity.checks import Check
from probity.functions.thresholds import parse_duration, parse_share


@dataclass
class ContractRule:
    rule_id: str
    table: str
    source: str  # e.g. "field.required", "quality.text", "model.referential_integrity"
    description: str
    check: Check | None = None
    skip_reason: str | None = None


@dataclass
class Contract:
    tables: list[str]
    declared: dict[str, dict[str, str]]  # table -> column -> declared type
    primary_keys: dict[str, list[str]]
    rules: list[ContractRule] = field(default_factory=list)
    pii: dict[str, list[str]] = field(default_factory=dict)
    retention: str | None = None
    raw: dict = field(default_factory=dict)

    @property
    def checks(self) -> list[Check]:
        return [r.check for r in self.rules if r.check is not None]


def _models(doc: dict) -> list[tuple[str, dict]]:
    """(name, model) of every table a contract declares, under ``models`` or ``schema``, as a mapping or a list."""
    declared = doc.get("models") or doc.get("schema") or ()
    pairs = declared.items() if hasattr(declared, "items") else ((m.get("name"), m) for m in declared if hasattr(m, "get"))
    found = [(name, body or {}) for name, body in pairs if name]
    if not found:
        raise ValueError("the contract declares no tables")
    return found


def _fields(model: dict) -> list[tuple[str, dict]]:
    f = model.get("fields") or model.get("properties") or {}
    if isinstance(f, dict):
        return [(k, v or {}) for k, v in f.items()]
    return [(x["name"], x) for x in f]


def load_contract(source: str | dict, as_of: str | None = None, text_values: bool = False) -> Contract:
    """``source``: YAML text, a path to a YAML file, or an already-parsed dict.
    ``as_of`` fixes "now" for freshness (never the wall clock in tests).
    ``text_values``: the tables hold texts (CSV and the like), so declared types are rules for the values and not
    for the schema: a value that does not convert breaks its rule."""
    if isinstance(source, str):
        import yaml

        text = open(source).read() if "\n" not in source and source.endswith((".yaml", ".yml")) else source
        doc = yaml.safe_load(text)
    else:
        doc = source
    models = _models(doc)
    tables = [name for name, _ in models]
    declared: dict[str, dict[str, str]] = {}
    pks: dict[str, list[str]] = {}
    rules: list[ContractRule] = []
    ids: set[str] = set()

    def add(table, source_, desc, check=None, skip=None, rid=None):
        rid = rid or (check.check_id if check else f"{table}:{source_}:{len(rules)}")
        base, i = rid, 1
        while rid in ids:
            i += 1
            rid = f"{base}#{i}"
        ids.add(rid)
        if check is not None and check.check_id != rid:
            check = Check(check.table, check.kind, check.columns, check.params, check.mostly,
                          check.must_be_less_than, check.unit, rid)
        if check is not None and text_values and check.kind == "column_values_to_be_of_type":
            check = replace(check, params={**check.params, "value_test": True})
        rules.append(ContractRule(rid, table, source_, desc, check, skip))

    for table, model in models:
        fields = _fields(model)
        declared[table] = {n: (f.get("physicalType") or f.get("type")) for n, f in fields}
        pk = model.get("primaryKey")
        if isinstance(pk, str):
            pk = [pk]
        pk = list(pk or [n for n, f in fields if f.get("primaryKey")])
        pks[table] = pk
        if pk:
            for c in pk:
                add(table, "primaryKey", f"{c} part of the primary key is not null",
                    Check(table, "column_values_to_not_be_null", (c,), check_id=f"{table}:{c}:pk_not_null"))
            kind = "column_values_to_be_unique" if len(pk) == 1 else "compound_columns_to_be_unique"
            add(table, "primaryKey", f"primary key {pk} is unique",
                Check(table, kind, tuple(pk), check_id=f"{table}:{'+'.join(pk)}:primary_key"))
        for col, f in fields:
            _field_rules(add, table, col, f, tables, pks)
        for q in model.get("quality") or []:
            _model_quality(add, table, q, tables, pks)

    sl = doc.get("servicelevels") or doc.get("serviceLevel") or {}
    fr = sl.get("freshness") or {}
    if fr:
        thr = fr.get("threshold") or fr.get("maxLatency")
        tsf = fr.get("timestampField")
        desc = fr.get("description", "freshness")
        if not tsf or "." not in tsf:
            add("*", "freshness", desc, skip="no timestampField declared", rid="contract:freshness")
        elif as_of is None:
            add(tsf.split(".")[0], "freshness", desc, skip="no as_of given", rid="contract:freshness")
        else:
            t, c = tsf.split(".", 1)
            add(t, "freshness", desc, Check(t, "freshness", (c,), {"as_of": as_of, "threshold_seconds": parse_duration(thr)},
                                            check_id=f"{t}:{c}:freshness"))
    ret = (sl.get("retention") or {}).get("period") if isinstance(sl.get("retention"), dict) else None
    pii: dict[str, list[str]] = {}
    for entry in ((doc.get("security") or {}).get("piiFields") or []):
        pii.setdefault(entry["model"], []).extend(entry.get("fields") or [])
    for table, model in models:
        for col, f in _fields(model):
            if f.get("pii"):
                pii.setdefault(table, []).append(col)
    pii = {t: list(dict.fromkeys(cols)) for t, cols in pii.items()}
    return Contract(tables, declared, pks, rules, pii, ret, doc)


def _ref(ref: str, tables: list[str], pks: dict[str, list[str]], fallback_col: str):
    if "." in ref:
        t, c = ref.split(".", 1)
    else:
        t = ref
        c = (pks.get(t) or [fallback_col])[0] if len(pks.get(t) or []) <= 1 else fallback_col
    return t, c


def _fk(add, table, col, ref, tables, pks, desc, source_):
    t, c = _ref(ref, tables, pks, col)
    cid = f"{table}:{col}:foreign_key"
    if t not in tables:
        add(table, source_, desc, skip=f"parent table {t} is not in the contract", rid=cid)
    else:
        add(table, source_, desc, Check(table, "foreign_key", (col,), {"parent_table": t, "parent_columns": [c]}, check_id=cid))


def _field_rules(add, table, col, f, tables, pks):
    if f.get("required"):
        add(table, "field.required", f"{col} is required", Check(table, "column_values_to_not_be_null", (col,)))
    if f.get("unique"):
        add(table, "field.unique", f"{col} is unique", Check(table, "column_values_to_be_unique", (col,)))
    lo, hi = f.get("minimum"), f.get("maximum")
    if lo is not None or hi is not None:
        add(table, "field.range", f"{col} in [{lo}, {hi}]",
            Check(table, "column_values_to_be_between", (col,), {"min_value": lo, "max_value": hi}))
    if f.get("enum") is not None:
        add(table, "field.enum", f"{col} in {f['enum']}", Check(table, "column_values_to_be_in_set", (col,), {"value_set": list(f["enum"])}))
    if f.get("pattern"):
        add(table, "field.pattern", f"{col} matches {f['pattern']}",
            Check(table, "column_values_to_match_regex", (col,), {"regex": f["pattern"]}))
    ml = f.get("maxLength")
    mn = f.get("minLength")
    if ml is None:
        m = re.match(r"^\s*(?:var)?char\((\d+)\)", str(f.get("physicalType") or ""), re.I)
        ml = int(m.group(1)) if m else None
    if ml is not None or mn is not None:
        add(table, "field.length", f"{col} length in [{mn}, {ml}]",
            Check(table, "column_value_lengths_to_be_between", (col,), {"min_value": mn, "max_value": ml}))
    if f.get("type"):
        add(table, "field.type", f"{col} is {f['type']}", Check(table, "column_values_to_be_of_type", (col,), {"type_": f["type"]}))
    if f.get("references"):
        _fk(add, table, col, f["references"], tables, pks, f"{col} references {f['references']}", "field.references")
    for q in f.get("quality") or []:
        _field_quality(add, table, col, q, tables, pks)


def _field_quality(add, table, col, q, tables, pks):
    """The check of one quality entry.  ``threshold``: a share of good (``">95%"``) or bad (``"<5%"``) rows, in place of
    ``mustBeLessThan``."""
    share = q.get("threshold")
    if share is not None:
        parse_share(share)  # a threshold that is none ends the load
        plain = add

        def add(table, source_, desc, check=None, skip=None, rid=None):
            if check is not None and check.kind != "sql_scalar":
                check = replace(check, params={**check.params, "share": share}, must_be_less_than=None, unit=None)
            plain(table, source_, desc, check, skip, rid)

    desc = q.get("description", "")
    typ = q.get("type")
    metric = q.get("metric")
    mblt = q.get("mustBeLessThan")
    unit = q.get("unit")
    args = q.get("arguments") or {}
    if typ == "sql":
        add(table, "quality.sql", desc, Check(table, "sql_scalar", (col,), {"query": q["query"]}, must_be_less_than=mblt,
                                              check_id=f"{table}:{col}:sql"))
    elif metric == "invalidValues":
        add(table, "quality.invalidValues", desc,
            Check(table, "column_values_to_be_in_set", (col,), {"value_set": args.get("validValues", [])},
                  must_be_less_than=mblt if mblt is not None else 1, unit=unit, check_id=f"{table}:{col}:invalid_values"))
    elif metric == "nullValues":
        add(table, "quality.nullValues", desc,
            Check(table, "column_values_to_not_be_null", (col,), must_be_less_than=mblt if mblt is not None else 1, unit=unit,
                  check_id=f"{table}:{col}:null_values"))
    elif metric == "missingValues":
        sentinels = [v for v in args.get("missingValues", []) if v is not None]
        cond = f"`{col}` IS NULL" + (
            " OR trim(CAST(`{c}` AS STRING)) IN ({v})".format(c=col, v=", ".join("'" + str(s).replace("'", "''") + "'" for s in sentinels))
            if sentinels else ""
        )
        add(table, "quality.missingValues", desc,
            Check(table, "row_condition", (), {"expression": f"NOT ({cond})"}, must_be_less_than=mblt if mblt is not None else 1,
                  unit=unit, check_id=f"{table}:{col}:missing_values"))
    elif metric == "duplicateValues":
        add(table, "quality.duplicateValues", desc,
            Check(table, "column_values_to_be_unique", (col,), must_be_less_than=mblt if mblt is not None else 1, unit=unit,
                  check_id=f"{table}:{col}:duplicate_values"))
    elif typ == "text" or (desc and not metric):
        chk, reason = text_rule(table, col, desc, tables, pks)
        if chk is None:
            add(table, "quality.text", desc, skip=reason, rid=f"{table}:{col}:text")
        else:
            add(table, "quality.text", desc, chk)
    else:
        add(table, f"quality.{metric or typ}", desc, skip=f"unsupported quality entry {metric or typ}", rid=f"{table}:{col}:{metric or typ}")


def _model_quality(add, table, q, tables, pks):
    rule = q.get("rule")
    col = q.get("field")
    desc = q.get("description", rule or "")
    if rule == "accepted_values":
        add(table, "model.accepted_values", desc, Check(table, "column_values_to_be_in_set", (col,), {"value_set": list(q["values"])}))
    elif rule == "regex":
        add(table, "model.regex", desc, Check(table, "column_values_to_match_regex", (col,), {"regex": q.get("pattern") or q.get("regex")}))
    elif rule == "unique":
        add(table, "model.unique", desc, Check(table, "column_values_to_be_unique", (col,), check_id=f"{table}:{col}:rule_unique"))
    elif rule == "referential_integrity":
        _fk(add, table, col, q["references"], tables, pks, desc, "model.referential_integrity")
    elif rule == "custom":
        add(table, "model.custom", desc, Check(table, "row_condition", (), {"expression": q["expression"]},
                                              check_id=f"{table}::custom"))
    else:
        add(table, f"model.{rule}", desc, skip=f"unsupported rule {rule}", rid=f"{table}::{rule}")


# ------------------------------------------------------------ text rules

_NUM = r"(-?\d+(?:\.\d+)?)"


def text_rule(table: str, col: str, text: str, tables: list[str], pks: dict[str, list[str]]):
    """Documented sentence patterns -> (Check, None) or (None, reason)."""
    t = text.strip().rstrip(".")
    m = re.search(r'format\s+"([^"<]*)<\w+>"\s+where\s+<\w+>\s+(?:are|is)\s+numerics?', t, re.I)
    if m:
        return Check(table, "column_values_to_match_regex", (col,), {"regex": "^" + re.escape(m.group(1)) + r"\d+$"}), None
    m = re.search(_NUM + r"\s*%\s+of\s+(\w+)\s+(?:must|should) be (less|greater) than\s+" + _NUM, t, re.I)
    if m:
        share, c, rel, bound = float(m.group(1)) / 100.0, m.group(2), m.group(3).lower(), float(m.group(4))
        params = {"max_value": bound, "strict_max": True} if rel == "less" else {"min_value": bound, "strict_min": True}
        return Check(table, "column_values_to_be_between", (c,), params, mostly=share, check_id=f"{table}:{c}:share"), None
    m = re.search(r"must exist in\s+([\w.]+)", t, re.I)
    if m:
        ref = m.group(1)
        pt, pc = _ref(ref, tables, pks, col)
        if pt not in tables:
            return None, f"parent table {pt} is not in the contract"
        return Check(table, "foreign_key", (col,), {"parent_table": pt, "parent_columns": [pc]}, check_id=f"{table}:{col}:exists_in"), None
    m = re.search(r"(\w+)\s+must be (later|greater|earlier|less) than( or equal to)?\s+([A-Za-z_]\w*)", t, re.I)
    if m:
        a, rel, eq, b = m.group(1), m.group(2).lower(), bool(m.group(3)), m.group(4)
        if rel in ("earlier", "less"):
            a, b = b, a
        return Check(table, "column_pair_values_a_to_be_greater_than_b", (a, b), {"or_equal": eq},
                     check_id=f"{table}:{a}+{b}:order"), None
    m = re.search(r"must be present when\s+(\w+)\s*=\s*'?([\w-]+)'?", t, re.I)
    if m:
        cond_col, val = m.group(1), m.group(2)
        lit = val if re.fullmatch(_NUM, val) else "'" + val + "'"
        return Check(table, "conditional_not_null", (col,), {"condition": f"`{cond_col}` = {lit}"},
                     check_id=f"{table}:{col}:present_when"), None
    if re.search(r"must not be null|must be present|is required", t, re.I):
        return Check(table, "column_values_to_not_be_null", (col,), check_id=f"{table}:{col}:text_not_null"), None
    m = re.search(r'must (end|start) with\s+(?:"([^"]+)"|(.+?))\s*$', text.strip(), re.I)
    if m:
        # quoted text is taken as is; otherwise the sentence's final period is
        # dropped unless the word is a capitalised abbreviation (Inc., Ltd., Co.)
        raw = m.group(2) if m.group(2) is not None else m.group(3)
        if m.group(2) is None and raw.endswith(".") and not re.search(r"\b[A-Z][a-z]{0,4}\.$", raw):
            raw = raw[:-1]
        suffix = raw.replace("%", r"\%").replace("_", r"\_")
        pat = f"%{suffix}" if m.group(1).lower() == "end" else f"{suffix}%"
        return Check(table, "column_values_to_match_like_pattern", (col,), {"like_pattern": pat},
                     check_id=f"{table}:{col}:{m.group(1).lower()}s_with"), None
    m = re.search(r"must be between\s+" + _NUM + r"\s+and\s+" + _NUM, t, re.I)
    if m:
        return Check(table, "column_values_to_be_between", (col,), {"min_value": float(m.group(1)), "max_value": float(m.group(2))},
                     check_id=f"{table}:{col}:text_between"), None
    m = re.search(r"must be (greater|less) than( or equal to)?\s+" + _NUM + r"$", t, re.I)
    if m:
        v, eq = float(m.group(3)), bool(m.group(2))
        params = {"min_value": v, "strict_min": not eq} if m.group(1).lower() == "greater" else {"max_value": v, "strict_max": not eq}
        return Check(table, "column_values_to_be_between", (col,), params, check_id=f"{table}:{col}:text_bound"), None
    m = re.search(r"must be (?:one of|in)\s*[\[(]?([^\])]+)[\])]?$", t, re.I)
    if m:
        vals = [v.strip().strip("'\"") for v in re.split(r",|\bor\b", m.group(1)) if v.strip()]
        return Check(table, "column_values_to_be_in_set", (col,), {"value_set": vals}, check_id=f"{table}:{col}:text_domain"), None
    m = re.search(r"must match (?:the )?(?:pattern|regex|regular expression)\s+(.+)$", text.strip(), re.I)
    if m:
        pat = m.group(1).strip().strip("`'\"")
        return Check(table, "column_values_to_match_regex", (col,), {"regex": pat}, check_id=f"{table}:{col}:text_regex"), None
    if re.search(r"must be unique", t, re.I):
        return Check(table, "column_values_to_be_unique", (col,), check_id=f"{table}:{col}:text_unique"), None
    if re.search(r"must not be (?:empty|blank)", t, re.I):
        return Check(table, "row_condition", (), {"expression": f"`{col}` IS NULL OR length(trim(CAST(`{col}` AS STRING))) > 0"},
                     check_id=f"{table}:{col}:text_not_empty"), None
    return None, "text rule not understood"


__all__ = ["Contract", "ContractRule", "load_contract", "parse_share", "text_rule"]


def load_suites(text: str, table: str | None = None) -> list[Check]:
    """Stored expectation suites (JSON ``{name, expectations: [{type, kwargs,
    meta}]}``), one document or several concatenated in one text.  The table of
    a suite is ``table`` or the part of its name before the first dot
    (``"beds.2.1"`` -> ``beds``).  Check ids: ``meta.check_id`` when
    given, else the default, numbered when a suite repeats one."""
    import json

    dec = json.JSONDecoder()
    docs, i = [], 0
    while True:
        while i < len(text) and text[i].isspace():
            i += 1
        if i >= len(text):
            break
        doc, i = dec.raw_decode(text, i)
        docs.extend(doc if isinstance(doc, list) else [doc])
    checks: list[Check] = []
    seen: dict[str, int] = {}
    for doc in docs:
        t = table or str(doc.get("name", "")).split(".")[0]
        for e in doc.get("expectations") or []:
            c = Check.from_dict(t, e)
            if c.check_id in seen:
                seen[c.check_id] += 1
                c = Check(c.table, c.kind, c.columns, c.params, c.mostly, c.must_be_less_than, c.unit,
                          f"{c.check_id}#{seen[c.check_id]}")
            else:
                seen[c.check_id] = 1
            checks.append(c)
    return checks


def dump_suites(checks: list[Check]) -> str:
    """Checks as stored suites, one JSON document per table, that ``load_suites`` reads back."""
    import json

    docs: dict[str, list[dict]] = {}
    for c in checks:
        kwargs = dict(c.params)
        if len(c.columns) == 1:
            kwargs["column"] = c.columns[0]
        elif c.columns:
            pair = c.kind.startswith("column_pair_")
            kwargs.update(zip(("column_A", "column_B"), c.columns) if pair else {"column_list": list(c.columns)})
        if c.mostly != 1.0:
            kwargs["mostly"] = c.mostly
        docs.setdefault(c.table, []).append({"type": f"expect_{c.kind}", "kwargs": kwargs, "meta": {"check_id": c.check_id}})
    return "\n".join(json.dumps({"name": f"{t}.1", "expectations": e}, default=str) for t, e in docs.items())

"""The constraint catalogue on the provider platform's tables, with gaps and repeats planted in a second set of roles."""

from quizlens.operators import constraints as C
from quizlens.plans import integrity
from suite.registry import query, role
from suite.roles import PROVIDER

# branches without a course, repeated slugs, questions of which a part is gone, sessions of unknown size
role("i_course", """
SELECT id, ext_id, CASE WHEN id = 2 THEN 'africa' ELSE slug END AS slug, 100 AS load_id FROM {p_course} WHERE id <> 4
""")
role("i_question", "SELECT * FROM {p_question} WHERE id % 7 <> 3")
role("i_item", """
SELECT id, CASE WHEN id % 13 = 5 THEN NULL ELSE lesson_id END AS lesson_id, type_id + id % 3 AS type_id FROM {p_item}
UNION ALL SELECT id, lesson_id, type_id FROM {p_item} WHERE id % 17 = 2
""")
PLANTED = PROVIDER | {"course": "i_course", "question": "i_question", "item": "i_item"}


def _branch(r, names):
    """SQL of one rule: its broken keys."""
    table, columns = names[r.table], r.columns
    parent = f"'{r.parent}'" if isinstance(r, C.Parent) else "CAST(NULL AS VARCHAR)"
    head = f"SELECT '{r.kind}' AS kind, '{r.table}' AS \"table\", '{','.join(columns)}' AS columns, {parent} AS parent"
    if isinstance(r, C.NotNull):
        gap = " OR ".join(f"{c} IS NULL" for c in columns)
        return f"{head}, '' AS key, count(*) AS n FROM {{{table}}} WHERE {gap} HAVING count(*) > 0"
    key, filled = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns), " AND ".join(f"{c} IS NOT NULL" for c in columns)
    if isinstance(r, C.Unique):
        return f"{head}, concat_ws(',', {key}) AS key, count(*) AS n FROM {{{table}}} WHERE {filled} GROUP BY {', '.join(columns)} HAVING count(*) > 1"
    same = " AND ".join(f"p.{f} = c.{c}" for c, f in zip(columns, r.fields, strict=True))
    return (f"{head}, concat_ws(',', {key}) AS key, count(*) AS n FROM {{{table}}} c WHERE {filled} "
            f"AND NOT EXISTS (SELECT 1 FROM {{{names[r.parent]}}} p WHERE {same}) GROUP BY {', '.join(columns)}")


def violated(rules, names):
    return "\nUNION ALL\n".join(_branch(r, names) for r in rules)


def counted(rules, names):
    heads = " UNION ALL ".join(
        f"SELECT '{r.kind}' AS kind, '{r.table}' AS \"table\", '{','.join(r.columns)}' AS columns, "
        + (f"'{r.parent}'" if isinstance(r, C.Parent) else "CAST(NULL AS VARCHAR)") + " AS parent" for r in rules)
    return f"""
SELECT r.kind, r."table", r.columns, r.parent, count(v.n) AS broken_keys, CAST(coalesce(sum(v.n), 0) AS BIGINT) AS broken_rows
FROM ({heads}) r LEFT JOIN ({violated(rules, names)}) v
  ON v.kind = r.kind AND v."table" = r."table" AND v.columns = r.columns AND v.parent IS NOT DISTINCT FROM r.parent
GROUP BY r.kind, r."table", r.columns, r.parent"""


@query("integrity_structure", violated(integrity.PROVIDER, PLANTED))
def integrity_structure(t):
    """Q6: unique keys and references of the content tables, broken rules by key; each table is scanned once."""
    return _listed(t, PLANTED, integrity.PROVIDER)


@query("integrity_log", violated(integrity.PROVIDER_LOG, PLANTED))
def integrity_log(t):
    """Q6: not null, unique and references of both event logs."""
    return _listed(t, PLANTED, integrity.PROVIDER_LOG)


@query("integrity_summary", counted([*integrity.PROVIDER, *integrity.PROVIDER_LOG], PLANTED))
def integrity_summary(t):
    """Q6: all rules of the platform with the number of broken keys and rows."""
    return C.summary(t.view(PLANTED), [*integrity.PROVIDER, *integrity.PROVIDER_LOG])


def _listed(t, names, rules):
    rows = C.violations(t.view(names), rules)
    return rows.selectExpr("kind", "`table`", "columns", "parent", "array_join(key, ',') AS key", "n")

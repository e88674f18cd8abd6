from pulseboard.llm import lines
from tests.llm.tables import by_id, docs


def brute(rows, size=3):
    windows, out = {}, {}
    cut = {i: (t.split("\n") if t is not None else []) for i, t in rows}
    for i in sorted(cut):
        for k in range(len(cut[i]) - size + 1):
            windows.setdefault(tuple(cut[i][k : k + size]), (i, k))
    for i, own in cut.items():
        gone = set()
        for k in range(len(own) - size + 1):
            if windows[tuple(own[k : k + size])] != (i, k):
                gone |= set(range(k, k + size))
        out[i] = (len(own), len(gone), "\n".join(x for k, x in enumerate(own) if k not in gone))
    return out


def test_against_brute_force(spark):
    rows = [
        (5, "a\nb\nc\nd"),
        (1, "x\na\nb\nc\ny"),
        (2, "a\nb\nc\na\nb\nc"),
        (3, "\n\n\n\n"),
        (4, ""),
        (6, "b\nc\nd\ne"),
        (7, "one\ntwo"),
        (8, "\n".join(map(str, range(2000)))),
        (9, "\n".join(map(str, range(1000, 3000)))),
    ]
    found = by_id(lines.dedup(docs(spark, rows)), "n_lines", "n_removed", "text")
    assert found == brute(rows)


def test_null_repeated_and_clashing(spark):
    rows = [(1, None), (2, "a\nb\nc"), (2, "a\nb\nc"), (None, "a\nb\nc\nz")]
    table = docs(spark, rows).withColumnRenamed("lang", "n_lines")
    found = lines.dedup(table)
    assert found.columns.count("n_lines") == 1
    assert sorted((r.doc_id or 99, r.n_lines, r.n_removed, r.text or "-") for r in found.collect()) == [
        (1, 0, 0, "-"),
        (2, 3, 0, "a\nb\nc"),
        (2, 3, 0, "a\nb\nc"),
        (99, 4, 3, "z"),
    ]


def test_only_columns_and_no_python(spark):
    plan = lines.dedup(docs(spark, [(1, "a")]).repartition(2))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_empty_table(spark):
    assert lines.dedup(docs(spark, [])).collect() == []

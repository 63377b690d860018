from branchwise.llm import linededup as ld

WHITE = " \t\n\v\f\r"


def brute(rows, least):
    """(source, text left, n_lines, n_removed) of each row (source, text)."""
    sites = {}
    for s, t in rows:
        for line in (t or "").split("\n"):
            if s is not None and line.strip(WHITE):
                sites.setdefault(line.strip(WHITE), set()).add(s)
    out = []
    for s, t in rows:
        lines = [] if t is None else t.split("\n")
        left = [x for x in lines if len(sites.get(x.strip(WHITE), ())) < least]
        gone = len(lines) - len(left)
        out.append((s, "\n".join(left) if gone else t, len(lines), gone))
    return sorted(out, key=str)


def result(spark, rows, least):
    frame = spark.createDataFrame(rows, "source string, text string").selectExpr("*", "'x' AS h1", "'x' AS at", "'x' AS line", "'x' AS text_key", "7 AS n_lines")
    return sorted(((r.source, r.text, r.n_lines, r.n_removed) for r in ld.remove_boilerplate(frame, least).collect()), key=str)


def test_against_brute_force(spark):
    rows = [(f"s{s}", "\n".join([f"  on {n} sites\t" for n in range(1, 60) if s < n] + [f"own {s}", "", " "])) for s in range(60)]
    rows += [("s0", "on 9 sites\n" * 500), (None, "on 30 sites\nkept"), ("s1", None), ("s1", ""), ("s1", "on 30 sites"), ("s1", "on 30 sites"), ("s2", "z" * 100_000)]
    for least in (3, 10, 40):
        assert result(spark, rows, least) == brute(rows, least)


def test_odd_rows(spark, odd_docs):
    got = ld.remove_boilerplate(odd_docs, 2)
    assert got.count() == 10 and set(odd_docs.columns) <= set(got.columns)
    assert {r.doc_id: r.n_removed for r in got.collect()}[2] == 1
    assert ld.remove_boilerplate(odd_docs.limit(0)).count() == 0

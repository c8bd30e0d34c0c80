from collections import Counter

from corpus import by_id, frame
from pyspark.sql import functions as F

from ledgerflow.llm.line_dedup import drop_boilerplate

SPACES = " \t\n\x0b\x0c\r"


def brute(rows, ratio=0.08, least=2):
    total, pages = Counter(), Counter()
    for text, host in {(text, host) for _, text, host in rows}:
        total[host] += 1
        for line in {x.strip(SPACES) for x in (text or "").split("\n")} - {""}:
            pages[host, line] += 1
    drop = {k for k, n in pages.items() if n >= least and n > total[k[0]] * ratio}
    out = {}
    for i, text, host in rows:
        lines = (text or "").split("\n")
        gone = [x for x in lines if (host, x.strip(SPACES)) in drop]
        kept = None if text is None else "\n".join(x for x in lines if (host, x.strip(SPACES)) not in drop)
        out[i] = (kept, sum(bool(x.strip(SPACES)) for x in lines), len(gone))
    return out


def site_rows():
    rows = []
    for i in range(160):
        host = None if i % 10 == 9 else f"host{i % 3}"
        lines = [f"line {i} {k}" for k in range(i % 4)]
        if i % 3 == 0:
            lines += [" Share this page \t", "", "Cookies"]
        if i % 7 == 0:
            lines.insert(0, "Cookies")
        if i % 50 == 0:
            lines = ["Cookies"]
        rows.append((i, "\n".join(lines), host))
    return rows + [(500, None, "host0"), (501, "", "host0"), (502, "Cookies\n\n \nCookies", "host1"),
                   (503, "\n".join(f"row {k}" for k in range(20_000)) + "\nCookies", "host0")]


def result(df):
    return {i: (r.text, r.n_lines, r.n_dropped) for i, r in by_id(df).items()}


def test_matches_brute_force(spark):
    rows = site_rows()
    assert result(drop_boilerplate(frame(spark, rows))) == brute(rows)


def test_small_hosts_keep_their_lines(spark):
    rows = [(i, "only line", "tiny") for i in range(4)]
    assert all(r.text == "only line" for r in drop_boilerplate(frame(spark, rows)).collect())


def test_repeated_line_of_a_small_host(spark):
    rows = [(i, f"own {i}\nshared" if i < 2 else f"own {i}", "tiny") for i in range(4)]
    assert result(drop_boilerplate(frame(spark, rows))) == brute(rows)
    assert [r.text for r in drop_boilerplate(frame(spark, rows)).orderBy("doc_id").collect()] == [
        "own 0", "own 1", "own 2", "own 3"]


def test_copies_are_one_page(spark):
    body = "\n".join(f"body {k}" for k in range(20))
    rows = [(i, body, "h") for i in range(60)] + [(100 + i, f"page {i}\nMenu", "h") for i in range(120)]
    got = result(drop_boilerplate(frame(spark, rows)))
    assert got == brute(rows) and got[0] == (body, 20, 0) and got[100] == ("page 0", 2, 1)


def test_repeated_rows_clashes_and_empty(spark):
    rows = site_rows()
    df = frame(spark, rows + rows[:5])
    assert drop_boilerplate(df).count() == len(rows) + 5
    clash = frame(spark, rows).withColumns({"host": F.lit("x"), "n_lines": F.lit(7), "row": F.lit(1), "line": F.lit(2)})
    out = drop_boilerplate(clash)
    assert out.columns == [*clash.columns, "n_dropped"]
    assert result(out) == brute(rows)
    assert drop_boilerplate(df.filter("false")).count() == 0

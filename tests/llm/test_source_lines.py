"""Repeated lines of a source."""

from regatlas.llm import source_lines as sl

SCHEMA = "block_id long, source string, doc_file string, type string, text string, text_level int, page_idx int, norm string, line string, n_documents int"


def frame(spark, rows):
    return spark.createDataFrame([(i, s, d, t, x, lv, 0, "n", "l", 1) for i, (s, d, t, x, lv) in enumerate(rows)], SCHEMA)


def test_lines(spark):
    rows = [("a", f"d{i}", "text", f"Body number {'abcdefghij'[i]}\nShare  THIS page {i}", None) for i in range(4)]
    rows += [("a", "d0", "text", "only here\n" * 50, None), ("b", "e0", "text", "Share this page 1", None), ("b", "e1", "text", "Share this page", None)]
    rows += [("a", "d9", "header", "Share this page", None), ("a", "d8", "text", "share this page", 1), ("a", "d7", "text", None, None), ("a", "d6", "text", "", None)]
    rows += [(None, f"n{i}", "text", "lost line", None) for i in range(4)] + [("a", f"d{i}", "text", "12 34\n--", None) for i in range(4)] + [("a", f"d{i}", "text", " share this page ", None) for i in range(2)]
    df = frame(spark, rows)
    got = {(r.block_id, r.line_no) for r in sl.repeated_lines(df.union(df)).collect()}
    assert got == {(i, 2) for i in range(4)} | {(len(rows) - 2, 1), (len(rows) - 1, 1)}
    (line,) = sl.excessive_lines(df).collect()
    assert (line.source, line.norm, line.n_documents) == ("a", "share this page", 4)
    clean = {r.block_id: (r.clean_text, r.removed) for r in sl.without_repeated_lines(df).collect()}
    assert clean[0] == ("Body number a", 1) and clean[5] == ("Share this page 1", 0) and clean[len(rows) - 1] == ("", 1) and clean[10] == ("", 0)


def test_share_of_documents(spark):
    rows = [("a", f"d{i}", "text", "rare line" if i < 3 else f"{'x' * (i + 1)}", None) for i in range(31)]
    assert sl.repeated_lines(frame(spark, rows)).count() == 0
    assert sl.repeated_lines(frame(spark, rows[:30])).count() == 3
    assert sl.repeated_lines(frame(spark, [])).count() == 0

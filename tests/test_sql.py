from termloom.functions.sql import register


def test_sql_functions(spark):
    register(spark)
    r = spark.sql("select fold_backspaces('ab\\bX') as a, terminal_screen('x\\ry', 10, 3) as b, sequence_ratio('ab', 'ab') as c, tolerant_json('say [1]') as d").first()
    assert tuple(r) == ("aX", "y", 1.0, "[1]")
    rows = spark.sql("select k, l.line_no, l.line from values ('a\\nb', 1), (null, 2) as t(s, k), lateral text_lines(s) as l order by k, line_no").collect()
    assert [tuple(x) for x in rows] == [(1, 1, "a"), (1, 2, "b")]

"""Forum articles, signals and summaries."""

import datetime as dt

from pyspark.sql import functions as F

from rentscope import schemas
from rentscope.operators import ranking, signals
from rentscope.plans import jobs

STAMP = "2024-07-{:02d} 10:00:00"


def articles(spark, rows):
    return spark.createDataFrame(rows, "board string, url string, title string, date string, content string").withColumn(
        "author", F.lit("someone")
    )


def test_signal_of_an_article(spark):
    df = articles(spark, [
        ("Rent", "https://x/bbs/Rent/M.1.A.html", "大安套房 租金多少", "Wed Jul 26 21:06:35 2017",
         "月租 12,500 約 8坪 \n近捷運"),
        (None, "https://x/bbs/Rent/M.2.A.html", None, "7/26", None),
    ])
    first, second = signals.to_signals(df).orderBy("url").collect()
    assert first.thread_id == "M.1.A" and first.posted_at == dt.datetime(2017, 7, 26, 21, 6, 35)
    assert first.contains_pricing_question and first.districts == ["大安"]
    assert first.keywords == ["pricing", "studio", "大安"]
    assert first.extracted_prices_ntd == [12500] and first.extracted_areas_ping == [8.0]
    assert first.short_snippet == "月租 12,500 約 8坪 近捷運"
    assert (second.board, second.title, second.short_snippet, second.keywords) == ("", "", "", [])
    assert second.contains_pricing_question is False and second.posted_at is None


def test_keep_rule(spark):
    df = articles(spark, [
        ("b", "u/1", "大安 租金多少", STAMP.format(5), ""),
        ("b", "u/2", "租金多少", STAMP.format(5), ""),
        ("b", "u/3", "台北 租金多少", STAMP.format(5), ""),
        ("b", "u/4", "大安 12000", STAMP.format(1), ""),
        ("b", "u/5", "大安", STAMP.format(5), ""),
        ("b", "u/6", "大安 12000", "7/26", ""),
    ])
    found = signals.to_signals(df)
    since = dt.datetime(2024, 7, 3)

    def kept(*how):
        return [r.url[-1] for r in found.filter(signals.keep(*how)).orderBy("url").collect()]

    assert kept(True, since) == ["1", "3"]
    assert kept(False, since) == ["1", "2", "3"]
    assert kept(True, None) == ["1", "3", "4", "6"]


def test_hot_address_and_hot_board(spark):
    """Most rows are copies of one address, and most addresses are on one board."""
    rows = [("hot", "u/same", f"t{i}", STAMP.format(1 + i % 28), str(i)) for i in range(300)]
    rows += [("hot", f"u/{i}", "t", STAMP.format(1 + i % 20), "") for i in range(200)]
    rows += [("calm", "u/same", "t", None, ""), ("calm", "u/x", "t", STAMP.format(2), "")]
    got = signals.newest_articles(articles(spark, rows), per_board=7).collect()
    by_board = {}
    for r in got:
        by_board.setdefault(r.board, []).append(r)
    newest = {}
    for board, url, title, date, content in rows:
        rank = (date or "", title, content)
        if rank > newest.get((board, url), ("", "", "")) or (board, url) not in newest:
            newest[(board, url)] = rank
    wanted = sorted(
        (u for b, u in newest if b == "hot"),
        key=lambda u: (-int((newest[("hot", u)][0] or "0000-00-00")[8:10]), u),
    )[:7]
    assert sorted(r.url for r in by_board["hot"]) == sorted(wanted)
    assert {r.url for r in by_board["calm"]} == {"u/same", "u/x"}
    same = [r for r in by_board["hot"] if r.url == "u/same"]
    assert len(same) == 1 and same[0].date == STAMP.format(28)
    since = dt.datetime(2024, 7, 20)
    assert signals.newest_articles(articles(spark, rows), None, since).count() == 11


def signal_rows(spark, rows):
    return spark.createDataFrame(
        [(i, f"t{i}", b, f"title {i}", q, k, d, p) for i, (b, q, k, d, p) in enumerate(rows)],
        "n int, thread_id string, board string, title string, contains_pricing_question boolean, "
        "keywords array<string>, districts array<string>, extracted_prices_ntd array<bigint>",
    )


def test_summaries(spark):
    df = signal_rows(spark, [
        ("b", True, ["pricing", "tool"], ["大同"], [9000, 12001]),
        ("a", False, ["大同", "中山"], ["大同", "中山"], [12000, 400000]),
        ("", None, ["中山"], ["中山"], []),
    ])
    row = signals.report_summary(df, "n").first()
    assert row.threads_analyzed == 3 and row.pricing_question_ratio == 0.333
    assert [tuple(x) for x in row.top_keywords] == [
        ("中山", 2), ("pricing", 1), ("tool", 1), ("大同", 1),
    ]
    assert [tuple(x) for x in row.top_districts] == [("大同", 2), ("中山", 2)]
    assert row.median_extracted_rent_ntd == 12000 and row.rent_mentions_observed == 3
    full = signals.overview(df, "n").first()
    assert full.tool_seeking_ratio == 0.333 and full.median_extracted_rent_ntd == 12000.5
    assert full.board_count == 2
    assert sorted(tuple(x) for x in signals.boards(df, "n").collect()) == [(1, "b", 1), (2, "a", 1)]
    assert [x.title for x in full.example_titles] == ["title 0", "title 1", "title 2"]


def test_median_is_cut_and_list_is_limited(spark):
    tags = [f"k{i:02d}" for i in range(12)]
    df = signal_rows(spark, [("b", True, tags, [], [2001, 2002]), ("b", True, tags[3:], [], [])])
    row = signals.report_summary(df, "n").first()
    assert row.median_extracted_rent_ntd == 2001
    assert [x.key for x in row.top_keywords] == tags[3:] + ["k00"]


def test_empty_summaries(spark):
    empty = spark.createDataFrame([], "n int, " + schemas.SIGNALS)
    row = signals.report_summary(empty).first()
    assert row.threads_analyzed == 0 and row.pricing_question_ratio is None
    assert row.top_keywords == [] and row.median_extracted_rent_ntd is None
    full = signals.overview(empty, "n").first()
    assert full.pricing_question_ratio == 0.0 and full.tool_seeking_ratio == 0.0
    assert full.board_count == 0 and full.example_titles == [] and signals.boards(empty, "n").count() == 0


def test_many_boards_are_a_table(spark):
    """200 000 boards, one of them with a third of the signals."""
    board = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("b"), (F.col("id") % 299_999).cast("string")))
    df = spark.range(450_000).select(F.col("id").cast("int").alias("n"), board.alias("board"))
    found = signals.boards(df, "n")
    told = found.agg(F.count("*").alias("n"), F.sum("count").alias("rows"), F.countDistinct("rank").alias("ranks"), F.max("rank").alias("last")).first()
    different = df.select("board").distinct().count()
    assert different > 199_000 and (told.n, told.rows, told.ranks, told.last) == (different, 450_000, different, different)
    assert [tuple(r) for r in found.where("rank = 1").collect()] == [(1, "hot", 150_000)]
    first = df.where("board <> 'hot'").groupBy("board").agg(F.count("*").alias("c"), F.min("n").alias("f"))
    wanted = [r.board for r in first.orderBy(F.desc("c"), "f").limit(50).collect()]
    assert [r.key for r in found.where("rank between 2 and 51").orderBy("rank").collect()] == wanted


def test_tally_counts_across_a_hot_key(spark):
    df = spark.range(1000).select(
        "id", F.when(F.col("id") % 3 == 0, F.array(F.lit("z"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("k")
    )
    counts = ranking.tally(df, {"k": F.col("k")}, "id")
    got = [(r.key, r["count"]) for r in ranking.top_keys(counts, 2).orderBy("rank").collect()]
    assert got == [("a", 666), ("b", 666)]


def test_ties_go_by_place_in_long_rows_and_large_orders(spark):
    names = [f"k{i:04d}" for i in reversed(range(1200))]
    df = spark.createDataFrame([(2**60, names)], "id long, k array<string>")
    got = ranking.top_keys(ranking.tally(df, {"k": F.col("k")}, "id"), 1200).orderBy("rank").collect()
    assert [r.key for r in got] == names


def test_job_writes_threads_signals_and_csv(spark, tmp_path):
    boards = [
        articles(spark, [("b", "u/M.1.html", "大安 租金多少", STAMP.format(5), "a\n\"quoted\", 9000 元")]),
        articles(spark, [("c", "u/M.2.html", "none", STAMP.format(5), "")]),
    ]
    out = str(tmp_path)
    found = jobs.forum_signals(boards, output=out)
    assert [r.thread_id for r in found.collect()] == ["M.1"]
    threads = spark.read.json(f"{out}/threads")
    assert threads.count() == 2 and "content" not in threads.columns
    stored = spark.read.json(f"{out}/signals").first()
    assert stored.posted_at == "2024-07-05T10:00:00" and stored.districts == ["大安"]
    first = next((tmp_path / "signals_csv").glob("part-*")).read_bytes()
    assert first.startswith(b"\xef\xbb\xbf")
    csv = spark.read.csv(f"{out}/signals_csv", header=True, escape='"', multiLine=True).first()
    assert csv.extracted_prices_ntd == "[9000]" and csv.short_snippet == 'a "quoted", 9000 元'

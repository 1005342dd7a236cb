from recspark.operators import stats, tags


def _movies(spark, rows):
    return spark.createDataFrame(rows, "mid int, name string, genres string")


def test_genre_substring_semantics(spark):
    movies = _movies(spark, [(1, "a", "Musical"), (2, "b", "Sci-Fi"), (3, "c", "Steward"),
                             (4, "d", ""), (5, "e", "Drama|War")])
    avg = spark.createDataFrame([(i, float(i)) for i in range(1, 6)], "mid int, avg double")
    got = {(r.genre, r.mid) for r in
           stats.genre_top_n(movies, avg, ["Music", "Science", "War", "Drama"]).collect()}
    assert got == {("Music", 1), ("War", 3), ("War", 5), ("Drama", 5)}
    tok = {(r.genre, r.mid) for r in
           stats.genre_top_n(movies, avg, ["Music", "War"], match="token").collect()}
    assert tok == {("War", 5)}


def test_genre_top_ties_and_cut(spark):
    movies = _movies(spark, [(i, f"m{i}", "Action") for i in range(12, 0, -1)])
    avg = spark.createDataFrame([(i, 4.0) for i in range(1, 13)], "mid int, avg double")
    rows = stats.genre_top_n(movies, avg, ["Action", "Foreign"]).orderBy("rk").collect()
    assert [r.mid for r in rows] == list(range(1, 11))
    assert [r.rk for r in rows] == list(range(1, 11))


def test_popularity_month_average(spark):
    r = spark.createDataFrame([(1, 10, 4.0, 1260759144), (2, 10, 3.0, 1260759144),
                               (1, 11, 5.0, 1230768000)], "uid int, mid int, score double, ts int")
    assert {tuple(x) for x in stats.item_popularity(r).collect()} == {(10, 2), (11, 1)}
    assert {tuple(x) for x in stats.item_popularity_by_month(r).collect()} == {
        (10, 2, 200912), (11, 1, 200901)}
    assert {tuple(x) for x in stats.item_average(r).collect()} == {(10, 3.5), (11, 5.0)}
    s = stats.dataset_summary(r).first()
    assert (s.n_ratings, s.n_users, s.n_items) == (3, 2, 2)


def test_tags_distinct_sorted_and_left_join(spark):
    t = spark.createDataFrame([(1, 1, "b", 0), (2, 1, "a", 0), (3, 1, "b", 0)],
                              "uid int, mid int, tag string, ts int")
    m = _movies(spark, [(1, "x", "G"), (2, "y", "G")])
    got = {r.mid: r.tags for r in tags.items_with_tags(m, t).collect()}
    assert got == {1: "a|b", 2: None}

import os
import tempfile

import pytest

from recspark import sources


def _write(spark, lines):
    d = tempfile.mkdtemp(prefix="recspark-src-")
    p = os.path.join(d, "in.txt")
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_movie_lines_quarantine(spark):
    lines = [
        "1^Toy^d^90^2000^2001^en^Comedy|Family^a|b^dir",      # good
        "2^ Padded  ^d^90^2000^2001^en^ Drama ^a^dir",         # padded fields
        "3^Short^d^90^2000^2001^en^Drama^a",                   # 9 fields
        "4^Trail^^^^^^Drama^^",                                # trailing empties kept
        "x^BadId^d^90^2000^2001^en^Drama^a^dir",               # bad id
    ]
    good, bad = sources.read_movies_text(spark, _write(spark, lines))
    g = {r.mid: r for r in good.collect()}
    assert sorted(g) == [1, 2, 4]
    assert g[2].name == "Padded" and g[2].genres == "Drama"
    assert g[4].genres == "Drama" and g[4].actors == ""
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["bad number", "too few fields"]


def test_rating_csv_and_messages(spark):
    p = _write(spark, ["1,2,4.5,1260759144", "1,2,4.5", "1,x,4.5,1", ""])
    good, bad = sources.read_ratings_csv(spark, p)
    assert [tuple(r) for r in good.collect()] == [(1, 2, 4.5, 1260759144)]
    assert bad.count() == 3
    msgs = spark.createDataFrame([("7|8|3.5|100",), ("7|8|abc|100",), ("7|8",)], "value string")
    good, bad = sources.parse_rating_messages(msgs)
    assert [tuple(r) for r in good.collect()] == [(7, 8, 3.5, 100)]
    assert bad.count() == 2


def test_tab_and_pipe_take_first_fields(spark):
    good, _ = sources.read_tab_ratings(spark, _write(spark, ["10\t20\t3\t999"]))
    assert [tuple(r) for r in good.collect()] == [(10, 20, 3.0)]
    good, _ = sources.read_item_titles(spark, _write(spark, ["5|Title (1995)|01-Jan-1995||http://x"]))
    assert [tuple(r) for r in good.collect()] == [(5, "Title (1995)")]


def test_upsert_log_latest_wins_and_replay(spark):
    from pyspark.sql import functions as F
    path = tempfile.mkdtemp(prefix="recspark-upsert-") + "/log"
    b0 = spark.createDataFrame([(1, "a"), (2, "b")], "uid int, v string")
    b1 = spark.createDataFrame([(2, "c")], "uid int, v string")
    sources.upsert_log_write(b0, path, 0)
    sources.upsert_log_write(b1, path, 1)
    sources.upsert_log_write(b1, path, 1)  # replayed batch replaces itself
    got = {r.uid: r.v for r in sources.upsert_log_read(spark, path, "uid").collect()}
    assert got == {1: "a", 2: "c"}
    assert spark.read.parquet(path).where(F.col("batch_id") == 1).count() == 1


def test_recent_lists_encoded(spark):
    from pyspark.sql import functions as F
    lists = spark.createDataFrame([("uid:7", ["5:4.5", " 6 : 3.0 ", "x:1", "8:2.0"]),
                                   ("uid:9", []), ("nokey", ["1:2.0"])],
                                  "key string, items array<string>")
    good, bad = sources.parse_recent_lists(lists, k=3)
    assert [tuple(r) for r in good.orderBy("rn").collect()] == [(7, 1, 5, 4.5), (7, 2, 6, 3.0)]
    assert sorted((r.line, r.reason) for r in bad.collect()) == [
        ("1:2.0", "bad key"), ("x:1", "bad number")]
    df = spark.createDataFrame([(7, 5, 4.5)], "uid int, mid int, score double")
    row = df.select(sources.recent_list_key(F.col("uid").cast("string")).alias("k"),
                    sources.encode_recent_item().alias("v")).first()
    assert (row.k, row.v) == ("uid:7", "5:4.5")


def test_upsert_log_compaction(spark):
    path = tempfile.mkdtemp(prefix="recspark-compact-") + "/log"
    mk = lambda rows: spark.createDataFrame(rows, "uid int, v string")
    sources.upsert_log_write(mk([(1, "a"), (2, "b")]), path, 0)
    sources.upsert_log_write(mk([(2, "c")]), path, 1)
    assert sources.upsert_log_compact(spark, path, "uid") == 1
    sources.upsert_log_write(mk([(1, "d"), (3, "e")]), path, 2)
    got = {r.uid: r.v for r in sources.upsert_log_read(spark, path, "uid").collect()}
    assert got == {1: "d", 2: "c", 3: "e"}
    assert sources.upsert_log_compact(spark, path, "uid") == 2
    got = {r.uid: r.v for r in sources.upsert_log_read(spark, path, "uid").collect()}
    assert got == {1: "d", 2: "c", 3: "e"}


def test_tabs_and_control_characters_are_trimmed(spark):
    from recspark.sources.text import parse_delimited
    lines = spark.createDataFrame([("\t 1 \t,\x01\ttag\t\x1f ,  2\t",)], "value string")
    good, bad = parse_delimited(lines, ",", [("a", "int"), ("tag", "string"), ("b", "int")])
    assert [tuple(r) for r in good.collect()] == [(1, "tag", 2)] and bad.count() == 0


def test_compaction_removes_what_no_reader_needs(spark):
    path = tempfile.mkdtemp(prefix="recspark-log-") + "/log"
    mk = lambda rows: spark.createDataFrame(rows, "uid int, v string")
    for b in range(6):
        sources.upsert_log_write(mk([(b % 3, f"v{b}"), (9, f"n{b}")]), path, b)
        sources.upsert_log_compact(spark, path, "uid")
    got = {r.uid: r.v for r in sources.upsert_log_read(spark, path, "uid").collect()}
    assert got == {0: "v3", 1: "v4", 2: "v5", 9: "n5"}
    folders = sorted(f for f in os.listdir(path) if f.startswith("batch_id="))
    assert folders == ["batch_id=5"]
    kept = sorted(f for f in os.listdir(path + "_snapshot") if f.startswith("upto="))
    assert kept == ["upto=4", "upto=5"]


def test_missing_shared_folder(spark):
    """Without spark.checkpoint.dir one machine gets a local folder, a cluster an
    error, and the session's settings stay as they are."""
    from recspark.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        applicationId, master = "app-1", "spark://somewhere:7077"
        folder = None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        conf, sparkContext = Conf(), Context()

    for master in ("spark://somewhere:7077", "yarn", "k8s://x", "local-cluster[3,2,1000]"):
        Session.sparkContext.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(Session)
    Session.sparkContext.master = "local[4]"
    assert "app-1" in checkpoint_root(Session)

"""Content-based similar items from genre text (P4, V2, V4, V5 + V3, W4).

Items with the same genre terms, in any order, have the same TF-IDF vector, so
vectors are built and compared once per distinct sorted term list (a group), and
the group-level similarities are expanded to items with a cut ``k``: each group
gives only its ``k + 1`` smallest item ids (ties order by id), enough for any
item's top ``k`` after its own id is removed.  The uncut list (W4) stays in its
factored form: pairs of groups, and the members of each group.

Items without a genre term count as items for the IDF but have no vector.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions import genre_text
from recspark.operators.similarity import similar_items
from recspark.operators.topk import top_k_per_key
from recspark.schema import HASHING_TF_FEATURES, ITEM_SIM_FLOOR
from recspark.session import saved


def _tokens(col):
    """V2: lower-case, '|' -> ' ', split on white space, drop empty tokens."""
    return F.filter(F.split(F.lower(genre_text(col)), r"\s"), lambda t: t != "")


def _groups(movies: DataFrame) -> DataFrame:
    """(mid, gkey): gkey is the sorted term list as text; no term -> no row."""
    terms = F.array_sort(_tokens(F.coalesce("genres", F.lit(""))))
    return (movies.select("mid", F.array_join(terms, "|").alias("gkey"))
            .where(F.col("gkey") != ""))


def tfidf_exact(movies: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Exact TF-IDF per distinct genre string -> (gkey, terms, weights); ``groups`` are
    the items' groups where these are at hand.

    idf = ln((m + 1) / (df + 1)) with m = number of items and df = number of
    items whose genres contain the term (Spark ML's IDF formula).
    """
    g = _groups(movies) if groups is None else groups
    m = movies.count()
    gsize = g.groupBy("gkey").agg(F.count(F.lit(1)).alias("gn"))
    tf = (gsize.select("gkey", "gn", F.explode(_tokens("gkey")).alias("term"))
          .groupBy("gkey", "gn", "term").agg(F.count(F.lit(1)).alias("tf")))
    df_ = tf.groupBy("term").agg(F.sum("gn").alias("df"))
    w = (tf.join(df_, "term")
         .select("gkey", "term",
                 (F.col("tf") * F.log((F.lit(m) + 1.0) / (F.col("df") + 1.0))).alias("w")))
    return (w.groupBy("gkey")
            .agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("_tw"))
            .select("gkey", F.col("_tw.term").alias("terms"), F.col("_tw.w").alias("weights")))


def tfidf_hashed(movies: DataFrame, num_features: int = HASHING_TF_FEATURES,
                 groups: DataFrame | None = None) -> DataFrame:
    """V2 + V4 + V5 with Spark ML: terms -> HashingTF -> IDF.

    IDF is fitted on all items, those without a term among them; vectors are
    produced per group -> (gkey, features ARRAY<DOUBLE>).
    """
    from pyspark.ml.feature import IDF, HashingTF
    from pyspark.ml.functions import vector_to_array

    htf = HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features)
    every = movies.select(_tokens(F.coalesce("genres", F.lit(""))).alias("words"))
    idf_model = IDF(inputCol="tf", outputCol="tfidf").fit(htf.transform(every))
    g = _groups(movies) if groups is None else groups
    distinct = g.select("gkey").distinct().withColumn(
        "words", F.split("gkey", r"\|"))
    vecs = idf_model.transform(htf.transform(distinct))
    return vecs.select("gkey", vector_to_array("tfidf").alias("features"))


def hashed_buckets(terms: DataFrame, num_features: int = HASHING_TF_FEATURES) -> DataFrame:
    """V4: (term, bucket) of a table of distinct terms, as HashingTF deals them."""
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array
    htf = HashingTF(inputCol="w", outputCol="v", numFeatures=num_features)
    v = htf.transform(terms.select("term", F.array("term").alias("w")))
    return v.select("term", (F.array_position(vector_to_array("v"), F.lit(1.0)) - 1)
                    .cast("int").alias("bucket"))


def expand_group_similarity(group_sims: DataFrame, members: DataFrame,
                            k: int) -> DataFrame:
    """(ga, gb, score) + (mid, gkey) -> (mid, sim_mid, score, rk) per item.

    Self pairs (mid == sim_mid) are removed; order is score desc, sim_mid asc.  An item
    of one row takes its group's ordered list as it is, less itself, so the items' lists
    are neither sorted nor shuffled; only ids of several rows have theirs merged.
    """
    smallest = top_k_per_key(
        members.select(F.col("gkey").alias("gb"), F.col("mid").alias("sim_mid")),
        "gb", [F.asc("sim_mid")], k + 1, "_r").drop("_r")
    per_group = top_k_per_key(
        group_sims.join(smallest, "gb").select("ga", "sim_mid", "score"),
        "ga", [F.desc("score"), F.asc("sim_mid")], k + 1, "_r")
    lists = saved(per_group.groupBy("ga").agg(F.sort_array(F.collect_list(
        F.struct("_r", "sim_mid", "score"))).alias("_l")), "content-lists")
    own = members.groupBy("mid").agg(F.count(F.lit(1)).alias("_n"), F.min("gkey").alias("ga"))
    others = F.slice(F.filter("_l", lambda x: x["sim_mid"] != F.col("mid")), 1, k)
    single = own.where("_n = 1").join(lists, "ga").select(
        "mid", F.posexplode(others).alias("_at", "_o")).select(
        "mid", F.col("_o.sim_mid").alias("sim_mid"), F.col("_o.score").alias("score"),
        (F.col("_at") + 1).cast("long").alias("rk"))
    repeated = members.join(own.where("_n > 1").select("mid"), "mid").select(
        "mid", F.col("gkey").alias("ga"))
    pairs = repeated.join(lists.select("ga", F.explode("_l").alias("_o")), "ga").select(
        "mid", "_o.sim_mid", "_o.score").where(F.col("mid") != F.col("sim_mid"))
    return single.unionByName(top_k_per_key(pairs, "mid",
                                            [F.desc("score"), F.asc("sim_mid")], k))


def _keyed_vectors(movies: DataFrame, groups: DataFrame, hashed: bool,
                   num_features: int) -> DataFrame:
    """(gid, gkey, vector columns): a group's id is its smallest item id, so two
    groups never share one.  Read several times, hence written once, to the
    shared folder, as are the items' groups."""
    vectors = (tfidf_hashed(movies, num_features, groups) if hashed
               else tfidf_exact(movies, groups))
    ids = groups.groupBy("gkey").agg(F.min("mid").alias("gid"))
    return saved(vectors.join(ids, "gkey"), "content-vectors")


def _group_sims(keyed: DataFrame, floor: float, k: int | None, digits, hashed: bool):
    kw = dict(id_col="gid", floor=floor, digits=digits, include_self=True,
              out_cols=("ga", "gb", "score"), rank_col=None)
    if k is not None:
        kw.update(k=k + 1, keep_ties=True)
    else:
        kw.update(k=None)
    if hashed:
        return similar_items(keyed, vec_col="features", **kw)
    return similar_items(keyed, vec_col="weights", keys_col="terms", **kw)


def similar_groups(movies: DataFrame, floor: float = ITEM_SIM_FLOOR, digits: int | None = None,
                   hashed: bool = False, num_features: int = HASHING_TF_FEATURES) -> DataFrame:
    """W4, factored: (ga, gb, score) of all groups above the floor, a group with
    itself included; a group is named by its smallest item id.  With
    ``group_members`` this is the whole uncut list, without writing it out item
    by item: items of ``ga`` and ``gb`` are similar by ``score``."""
    groups = saved(_groups(movies), "content-groups")
    return _group_sims(_keyed_vectors(movies, groups, hashed, num_features), floor, None, digits,
                       hashed)


def group_members(movies: DataFrame) -> DataFrame:
    """(mid, ga): the group of every item with a genre term."""
    g = _groups(movies)
    ids = g.groupBy("gkey").agg(F.min("mid").alias("ga"))
    return g.join(ids, "gkey").select("mid", "ga")


def content_similar_items(movies: DataFrame, k: int, floor: float = ITEM_SIM_FLOOR,
                          digits: int | None = None, hashed: bool = False,
                          num_features: int = HASHING_TF_FEATURES) -> DataFrame:
    """The k most similar items by genre TF-IDF -> (mid, sim_mid, score, rk).

    ``hashed=True`` follows the original feature pipeline (50 hashed buckets,
    collisions possible); the default uses exact terms.
    """
    groups = saved(_groups(movies), "content-groups")
    keyed = _keyed_vectors(movies, groups, hashed, num_features)
    members = groups.join(keyed.select("gkey", "gid"), "gkey").select(
        "mid", F.col("gid").alias("gkey"))
    return expand_group_similarity(_group_sims(keyed, floor, k, digits, hashed), members, k)

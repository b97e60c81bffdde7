"""Index records: merge of URL/ACL updates (C6 with P21/P22), URL removal
(C7), record deletion (C8), ids missing from the index (A11) and the
indexing status of copied files (C13)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from objsync import config as C
from objsync.config import PlanConfig
from objsync.functions import acl as A
from objsync.functions import routing as R
from objsync.functions import urls as U
from objsync.operators.inventory import inventory_by_key, listed, probe_join
from objsync.operators.projects import attach_projects

INDEX_SCHEMA = ("did string, urls array<string>, urls_metadata map<string,map<string,string>>, "
                "acl array<string>, authz array<string>, hashes map<string,string>, size bigint")


def index_from_long_form(urls_long: DataFrame, attrs: DataFrame) -> DataFrame:
    """Index records from ``(did, pos, url)`` rows and ``(did, md5, size,
    acl1, authz1)`` attributes.  Grouping is per record (a handful of URLs)."""
    urls = (urls_long.groupBy("did")
            .agg(F.sort_array(F.collect_list(F.struct(F.col("pos"), F.col("url")))).alias("_u"))
            .select("did", F.transform("_u", lambda x: x["url"]).alias("urls")))
    empty_meta = F.create_map().cast("map<string,string>")
    return (attrs.join(urls, "did", "left")
            .select("did",
                    F.coalesce(F.col("urls"), F.array().cast("array<string>")).alias("urls"),
                    F.map_from_arrays(F.coalesce(F.col("urls"), F.array().cast("array<string>")),
                                      F.transform(F.coalesce(F.col("urls"), F.array().cast("array<string>")),
                                                  lambda _: empty_meta)).alias("urls_metadata"),
                    F.array(F.col("acl1")).alias("acl"), F.array(F.col("authz1")).alias("authz"),
                    F.create_map(F.lit("md5"), F.col("md5")).alias("hashes"),
                    F.col("size").cast("bigint").alias("size")))


def index_url_map(index: DataFrame) -> DataFrame:
    """``did -> urls``."""
    return index.select("did", "urls")


def _removable(new_url: Column, e: Column) -> Column:
    b1, b2 = U.url_netloc(new_url), U.url_netloc(e)
    pa, pb = C.SPECIAL_URL_BUCKET_PAIR
    special = ((b1 == pa) & (b2 == pb)) | ((b1 == pb) & (b2 == pa))
    return (U.url_scheme(new_url) == U.url_scheme(e)) & (special | (R.bucket_project_stem(b1) == R.bucket_project_stem(b2)))


def remove_changed_urls(urls: Column, new_url: Column) -> Column:
    """Drop the URLs of the same scheme that point to the same project's
    bucket (same P21 stem, or the special bucket pair).

    Reproduces the job's in-place removal while iterating: the element right
    after each removed one is skipped (kept unexamined).  Returns
    ``struct(kept, removed)``.
    """
    init = F.struct(F.array().cast("array<string>").alias("kept"),
                    F.array().cast("array<string>").alias("removed"),
                    F.lit(False).alias("skip"))

    def step(acc, e):
        keep = F.struct(F.concat(acc["kept"], F.array(e)).alias("kept"), acc["removed"].alias("removed"),
                        F.lit(False).alias("skip"))
        drop = F.struct(acc["kept"].alias("kept"), F.concat(acc["removed"], F.array(e)).alias("removed"),
                        F.lit(True).alias("skip"))
        return F.when(acc["skip"], keep).when(_removable(new_url, e), drop).otherwise(keep)

    return F.aggregate(urls, init, step, lambda acc: F.struct(acc["kept"].alias("kept"),
                                                             acc["removed"].alias("removed")))


def index_updates(rows: DataFrame, cfg: PlanConfig, url_col: str = "url") -> DataFrame:
    """Turn rows ``(line_no, id, acl, md5, size, <url_col>)`` into index
    updates with parsed ``acl_l``/``authz_l`` and ``valid``; rows with an
    invalid ACL are the job's failed updates (no change)."""
    return rows.select(
        "line_no", F.col("id").alias("did"), F.col(url_col).alias("url"), "md5", "size", "acl",
        A.acl_list("acl").alias("acl_l"), A.authz_list("acl", cfg.namespace()).alias("authz_l"),
        A.acl_valid("acl").alias("valid"))


#: Lines per block of the first reduction of a record's updates.
RUN_BLOCK = 1_000_000
_ACL = "acl"  # the track of a record's ACL; URL tracks hold "://"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Stems of the special pair; they make one class.
_SPECIAL_STEMS = [n[:-5] if n.endswith("-open") else n[:-11] for n in C.SPECIAL_URL_BUCKET_PAIR]


def _class_and_odd(url: Column) -> Column:
    """``struct(cls, odd)`` of a URL, which is matched once.  ``odd``: in the special class, but
    not one of its two buckets, as such URLs do not all remove each other."""
    def of(head: Column) -> Column:
        netloc, scheme = F.substring_index(head, "://", -1), F.lower(F.substring_index(head, "://", 1))
        return _let(F.struct(netloc.alias("netloc"), R.bucket_project_stem(netloc).alias("stem"), scheme.alias("scheme")), lambda x: F.struct(
            F.concat(x["scheme"], F.lit("://"), F.when(x["stem"].isin(*_SPECIAL_STEMS), F.lit("/special")).otherwise(x["stem"])).alias("cls"),
            (x["stem"].isin(*_SPECIAL_STEMS) & ~x["netloc"].isin(*C.SPECIAL_URL_BUCKET_PAIR)).alias("odd")))

    return _let(U.url_head(url), of)


def url_class(url: Column) -> Column:
    """Scheme and P21 stem of a URL: only URLs of one class remove each other.
    The stems of the special pair make one class."""
    return _class_and_odd(url)["cls"]


def index_transitions(updates: DataFrame, cfg: PlanConfig, block: int = RUN_BLOCK, partitions: int | None = None) -> DataFrame:
    """What all updates of a did amount to, whatever its record holds:
    ``(did, head, tracks, acl_first, acl_last, acl_single)``.

    A record's updates are tracks: one per URL class, and the ACL.  Of a track
    only its last run of equal values counts (where it began, its value) and
    whether there was any other run.  Tracks combine: blocks of lines are
    reduced each by itself, so a record with a third of all updates is spread
    over as many tasks as it has blocks, and of each block one row per track goes on to
    meet the others, where only neighbouring blocks are compared.

    ``head`` is the first update; ``tracks`` has ``(at, url, cls, single)`` per
    URL class, ``at`` being the line that began the last run.  The result is dealt
    by did, over ``partitions`` tasks where given.
    """
    acl_set = F.concat_ws(",", F.sort_array(F.array_distinct("acl_l")))
    # dealt by did and block before an update becomes two values: it is shuffled once, the values of a did side by side
    dealt = updates.select("did", "line_no", "url", "md5", "size", "acl", acl_set.alias("acl_set"), F.floor(F.col("line_no") / block).alias("block")).repartition("did", "block")
    values = dealt.select("did", "line_no", "block", F.explode(F.array(
        F.struct(url_class(F.col("url")).alias("track"), F.col("url").alias("value"), F.col("md5").alias("more"), F.col("size").alias("size")),
        F.struct(F.lit(_ACL).alias("track"), F.col("acl_set").alias("value"), F.col("acl").alias("more"), F.lit(None).cast("bigint").alias("size")))).alias("v")) \
        .select("did", "line_no", "block", "v.*")
    by_block = Window.partitionBy("did", "track", "block").orderBy("line_no")
    point = F.struct("line_no", "value", "more", "size")
    starts = values.withColumn("before", F.lag("value").over(by_block)).filter(F.col("before").isNull() | (F.col("before") != F.col("value")))
    blocks = starts.groupBy("did", "track", "block").agg(F.count(F.lit(1)).alias("runs"), F.min(point).alias("first"), F.max(point).alias("last"))
    # one partitioning by did serves the comparison of blocks, the tracks and the records
    along = Window.partitionBy("did", "track").orderBy("block")
    blocks = (blocks.repartition(partitions, "did") if partitions else blocks.repartition("did")).withColumn("before", F.lag("last.value").over(along))
    edge = F.col("before").isNull() | (F.col("before") != F.col("first.value"))
    began = F.when(F.col("runs") > 1, F.col("last")).when(edge, F.col("first"))
    changes = F.col("runs") - 1 + F.when(edge & F.col("before").isNotNull(), 1).otherwise(0)
    tracks = blocks.groupBy("did", "track").agg(F.min("first").alias("first"), F.max(began).alias("last"), (F.sum(changes) == 0).alias("single"))
    is_acl = F.col("track") == _ACL
    url = F.struct(F.col("last.line_no").alias("at"), F.col("last.value").alias("url"), F.col("track").alias("cls"), "single")
    return tracks.groupBy("did").agg(
        F.min(F.when(~is_acl, F.col("first"))).alias("head"), F.sort_array(F.collect_list(F.when(~is_acl, url))).alias("tracks"),
        F.max(F.when(is_acl, F.col("first.more"))).alias("acl_first"), F.max(F.when(is_acl, F.col("last.more"))).alias("acl_last"),
        F.bool_and(F.when(is_acl, F.col("single"))).alias("acl_single"))


def _update_runs(up: DataFrame, namespace: str = "") -> DataFrame:
    """Per did, the first update of every run of identical updates, as
    ``ups: array<struct<line_no, url, acl_l, authz_l, md5, size>>`` sorted by
    line.  Two ACL texts that parse alike only add a run boundary, which the
    fold treats as a no-op.
    """
    sig = F.struct("url", "acl", "md5", "size")
    before = F.lag(sig).over(Window.partitionBy("did").orderBy("line_no"))
    runs = up.withColumn("_prev", before).filter(F.col("_prev").isNull() | (F.col("_prev") != sig))
    return runs.groupBy("did").agg(F.sort_array(F.collect_list(
        F.struct("line_no", "url", A.acl_list("acl").alias("acl_l"), A.authz_list("acl", namespace).alias("authz_l"), "md5", "size"))).alias("ups"))


def _fold(urls: Column, acl: Column, authz: Column, ups: Column) -> Column:
    """A record after its updates one by one: ``struct(urls, removed, acl,
    authz, changed)``, with the literal P22."""
    state0 = F.struct(urls.alias("urls"), F.array().cast("array<string>").alias("removed"), acl.alias("acl"),
                      authz.alias("authz"), F.lit(False).alias("changed"))

    def apply(st, u):
        present = F.array_contains(st["urls"], u["url"])
        rc = remove_changed_urls(st["urls"], u["url"])
        acl_same = A.same_set(st["acl"], u["acl_l"])
        authz_same = A.same_set(st["authz"], u["authz_l"])
        return F.struct(
            F.when(present, st["urls"]).otherwise(F.concat(rc["kept"], F.array(u["url"]))).alias("urls"),
            F.when(present, st["removed"]).otherwise(F.array_union(st["removed"], rc["removed"])).alias("removed"),
            F.when(acl_same, st["acl"]).otherwise(u["acl_l"]).alias("acl"),
            F.when(authz_same, st["authz"]).otherwise(u["authz_l"]).alias("authz"),
            (st["changed"] | ~present | ~acl_same | ~authz_same).alias("changed"))

    return F.aggregate(ups, state0, apply)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _apply(rec: Column, tracks: Column, acl: Column, namespace: str) -> Column:
    """A record ``(urls, acl, authz)`` after its transition, like ``_fold``.  A class whose only
    run is of a URL that the record lists keeps it in place; of every other class
    the record's URLs go and the last run's is appended where it began."""
    def after(x: Column) -> Column:
        gone = lambda i: F.array_contains(x["names"], F.get(x["classes"], i))
        acl_same = acl["single"] & A.same_set(rec["acl"], x["first"])
        authz_same = acl["single"] & A.same_set(rec["authz"], x["first_z"])
        return F.struct(
            F.concat(F.filter(rec["urls"], lambda e, i: ~gone(i)), x["added"]).alias("urls"),
            F.filter(rec["urls"], lambda e, i: gone(i)).alias("removed"),
            F.when(acl_same, rec["acl"]).otherwise(x["last"]).alias("acl"),
            F.when(authz_same, rec["authz"]).otherwise(x["last_z"]).alias("authz"),
            ((F.size(x["added"]) > 0) | ~acl_same | ~authz_same).alias("changed"))

    reset = F.filter(tracks, lambda t: ~(t["single"] & F.array_contains(rec["urls"], t["url"])))
    read = [A.acl_list(acl[c]).alias(c) for c in ("first", "last")]
    read += [A.authz_list(acl[c], namespace).alias(f"{c}_z") for c in ("first", "last")]
    return _let(reset, lambda r: _let(F.struct(
        F.transform(rec["urls"], url_class).alias("classes"), F.transform(r, lambda t: t["cls"]).alias("names"),
        F.transform(r, lambda t: t["url"]).alias("added"), *read), after))


def merge_index(index: DataFrame, updates: DataFrame, cfg: PlanConfig, changes_only: bool = False,
                block: int = RUN_BLOCK, partitions: int | None = None) -> DataFrame:
    """Apply updates to index records; several updates of one did count
    in ``line_no`` order.  Output: the merged index plus ``change`` in
    ``created | patched | unchanged | untouched``.

    Existing record: a URL not yet listed first removes the changed URLs
    (P22, also from ``urls_metadata``) and is appended; ``acl``/``authz``
    are replaced when their sets differ.  New record: ``hashes{md5}``,
    ``size`` (0 when null), ``urls = [data_api_url + did, url]``.

    Records are not folded update by update: ``index_transitions`` reduces
    all updates of a did, block by block, to one small row that is applied
    to its record.  That is exact while a record has at most one URL
    per class, which its updates keep up.  Where a class has several, P22 skips the element after each
    removed one and the outcome depends on every single update: the updates of such
    records (and of those with other buckets under the special pair's stems) are
    collected and folded in order instead.

    ``changes_only=True`` returns only the records that have updates (no
    ``untouched`` rows): the index is then the non-preserved side of a left
    join, which lets Spark's runtime Bloom filter prune the index scan when
    the update set is selective, instead of rewriting the whole index.

    ``partitions``: over so many tasks both sides are dealt by did; without it
    over as many as the session's shuffles have.
    """
    ups = updates.filter(F.col("valid") & F.col("url").isNotNull())
    api_url = F.concat(F.lit(cfg.data_api_url), F.col("did"))
    # long expressions of a row are bound once, not repeated in every test
    several = index.filter(_let(F.transform("urls", _class_and_odd), lambda x: (
        F.size(F.array_distinct(F.transform(x, lambda c: c["cls"]))) < F.size(x)) | F.exists(x, lambda c: c["odd"]))).select("did")
    also = ups.filter(_let(F.struct(_class_and_odd(F.col("url")).alias("new"), url_class(api_url).alias("api")),
                           lambda x: x["new"]["odd"] | (x["new"]["cls"] == x["api"]))).select("did")
    in_order = _update_runs(ups.join(several.unionByName(also), "did", "left_semi"), cfg.namespace())
    grouped = index_transitions(ups, cfg, block, partitions).join(in_order, "did", "left")
    docs = index.withColumn("_has_doc", F.lit(True))
    docs = docs.repartition(partitions, "did") if partitions else docs
    j = grouped.join(docs, "did", "left") if changes_only else docs.join(grouped, "did", "full_outer")
    has_doc = F.coalesce(F.col("_has_doc"), F.lit(False))
    head, touched = F.col("head"), F.col("head").isNotNull()
    none = F.array().cast("array<string>")
    start = F.struct(
        F.when(has_doc, F.coalesce("urls", none)).otherwise(F.array(api_url, head["value"])).alias("urls"),
        F.when(has_doc, F.coalesce("acl", none)).otherwise(A.acl_list(F.col("acl_first"))).alias("acl"),
        F.when(has_doc, F.coalesce("authz", none)).otherwise(A.authz_list(F.col("acl_first"), cfg.namespace())).alias("authz"))
    acl = F.struct(F.col("acl_first").alias("first"), F.col("acl_last").alias("last"), F.col("acl_single").alias("single"))

    def changed(rec: Column) -> Column:
        return F.when(F.col("ups").isNotNull(), _fold(rec["urls"], rec["acl"], rec["authz"], F.col("ups"))) \
            .otherwise(_apply(rec, F.col("tracks"), acl, cfg.namespace()))

    j = j.withColumn("_st", F.when(touched, _let(start, changed)))
    meta_src = F.when(has_doc, F.col("urls_metadata")).otherwise(F.create_map().cast("map<string,map<string,string>>"))
    return j.select(
        "did",
        F.when(touched, F.col("_st.urls")).otherwise(F.col("urls")).alias("urls"),
        F.when(touched, F.map_filter(meta_src, lambda k, v: ~F.array_contains(F.col("_st.removed"), k)))
        .otherwise(F.col("urls_metadata")).alias("urls_metadata"),
        F.when(touched, F.col("_st.acl")).otherwise(F.col("acl")).alias("acl"),
        F.when(touched, F.col("_st.authz")).otherwise(F.col("authz")).alias("authz"),
        F.when(has_doc, F.col("hashes")).otherwise(F.create_map(F.lit("md5"), head["more"])).alias("hashes"),
        F.when(has_doc, F.col("size")).otherwise(F.coalesce(head["size"], F.lit(0)).cast("bigint")).alias("size"),
        F.when(~touched, F.lit("untouched")).when(~has_doc, F.lit("created"))
        .when(F.col("_st.changed"), F.lit("patched")).otherwise(F.lit("unchanged")).alias("change"))


def remove_index_urls(index: DataFrame, removals: DataFrame) -> DataFrame:
    """Remove ``(did, url)`` pairs from ``urls`` and ``urls_metadata``.
    Record URLs are unique, so removing the first occurrence removes all;
    ``filter`` keeps the survivors' order and multiplicity (unlike
    ``array_except``)."""
    rm = removals.groupBy("did").agg(F.collect_set("url").alias("_rm"))
    j = index.join(rm, "did", "left")
    has = F.col("_rm").isNotNull()
    return j.select(
        "did",
        F.when(has, F.filter("urls", lambda u: ~F.array_contains(F.col("_rm"), u))).otherwise(F.col("urls")).alias("urls"),
        F.when(has, F.map_filter("urls_metadata", lambda k, v: ~F.array_contains(F.col("_rm"), k)))
        .otherwise(F.col("urls_metadata")).alias("urls_metadata"),
        "acl", "authz", "hashes", "size",
        has.alias("updated"))


def delete_index_records(index: DataFrame, dids: DataFrame) -> DataFrame:
    """Index minus the given dids (anti join)."""
    return index.join(dids.select("did").distinct(), "did", "left_anti")


def missing_from_index(manifest: DataFrame, index: DataFrame) -> DataFrame:
    """Manifest rows whose id has no index record (anti join; never a
    collected list)."""
    return manifest.join(index.select(F.col("did").alias("id")), "id", "left_anti")


def indexing_status(manifest: DataFrame, project_map: DataFrame, aws_inventory: DataFrame,
                    cfg: PlanConfig) -> DataFrame:
    """Per file, ``copy_success`` (object listed in its target bucket),
    ``index_success`` (the index update can be made: valid ACL) and ``msg``."""
    m = attach_projects(manifest, project_map, cfg)
    m = m.withColumn("target_bucket", R.aws_bucket("aws_bucket_prefix", "acl")) \
        .withColumn("object_path", U.object_key("id", "file_name"))
    m = probe_join(m, inventory_by_key(aws_inventory, dedupe=cfg.dedupe_inventory), F.col("object_path"))
    copied = F.col("known_project") & listed("objects", "target_bucket")
    valid = A.acl_valid("acl")
    return m.select(
        "line_no", "id", "object_path", "target_bucket",
        copied.alias("copy_success"), (copied & valid).alias("index_success"),
        F.when(copied & ~valid, A.bad_acl_message("acl")).alias("msg"))

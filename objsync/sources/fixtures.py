"""Stand-in inputs derived from the TESTDATA tables (see FIXTURES.md).

Each fixture is one SQL text that runs unchanged on Spark SQL and DuckDB,
so the Spark queries and the DuckDB oracle read identical inputs.  Table
references are written ``{name}``: Spark binds them to DataFrames
(``spark.sql(text, name=df)``), the oracle to CTE names.  The fixtures only
produce rows in the schemas the plans expect; none of them computes a plan
result.
"""

from __future__ import annotations

import os
import threading
import uuid
from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession

from objsync.session import release_shuffles

BASE_TABLES = ("orders", "documents", "pages")

FIXTURES: "OrderedDict[str, str]" = OrderedDict()

# P9 is deliberately missing from the map (unknown project).
FIXTURES["f_project_map"] = """
select * from (values
 ('P0','tcga','gdc-tcga-phs000178'),
 ('P1','target','gdc-target-phs000218'),
 ('P2','gdc-ccle','gdc-ccle'),
 ('P3','gdc-beataml1-cohort-phs001657','gdc-beataml1-cohort-phs001657'),
 ('P4','gdc-organoid-pancreatic-phs001611','gdc-organoid-pancreatic-phs001611'),
 ('P5','gdc-cmi-mbc-phs001709','gdc-cmi-mbc-phs001709'),
 ('P6','gdc-cgci-phs000235','gdc-cgci-phs000235'),
 ('P7','gdc-rebc-thyr-phs001134','gdc-rebc-thyr-phs001134'),
 ('P8','gdc-varepop-apollo-phs001374','gdc-varepop-apollo-phs001374')
) as t(project_id, aws_bucket_prefix, gs_bucket_prefix)
where project_id in (select 'P' || cast(o_custkey % 10 as string) from {orders})
"""

# Literal bucket names per project, independent of the routing code.
FIXTURES["f_project_buckets"] = """
select * from (values
 ('P0','tcga-2-open','tcga-2-controlled'),
 ('P1','gdc-target-phs000218-2-open','target-controlled'),
 ('P2','gdc-ccle-2-open','gdc-ccle-controlled'),
 ('P3','gdc-beataml1-cohort-phs001657-2-open','gdc-beataml1-cohort-phs001657-2-controlled'),
 ('P4','gdc-organoid-pancreatic-phs001611-2-open','gdc-organoid-pancreatic-phs001611-2-controlled'),
 ('P5','gdc-cmi-mbc-phs001709-open','gdc-cmi-mbc-phs001709-controlled'),
 ('P6','gdc-cgci-phs000235-2-open','gdc-cgci-phs000235-2-controlled'),
 ('P7','gdc-rebc-thyr-phs001134-open','gdc-rebc-thyr-phs001134-controlled'),
 ('P8','gdc-varepop-apollo-phs001374-2-open','gdc-varepop-apollo-phs001374-controlled')
) as t(project_id, open_bucket, controlled_bucket)
"""

FIXTURES["f_manifest"] = """
select k, k as line_no, id,
 case when k % 5 = 0 then 'file ' || cast(k as string) || '.bam' else 'file_' || cast(k as string) || '.vcf.gz' end as file_name,
 md5('content' || cast(k as string)) as md5,
 case when k % 97 = 0 then cast(0 as bigint) else cast(floor(o_totalprice * 100) as bigint) end as size,
 'released' as state, 'P' || cast(o_custkey % 10 as string) as project_id,
 md5('base' || cast(k as string)) as baseid, '1' as version, '12.0' as release,
 case when k % 211 = 0 then null
      when k % 101 = 0 then '[' || chr(39) || 'bad' || chr(39) || ']'
      when o_orderstatus = 'O' and k % 2 = 0 then '[' || chr(39) || 'open' || chr(39) || ']'
      when o_orderstatus = 'O' then '[u' || chr(39) || 'open' || chr(39) || ']'
      when o_orderstatus = 'F' then '[' || chr(39) || 'phs000178' || chr(39) || ']'
      when k % 3 = 0 then '*'
      else '[' || chr(39) || 'phs000178' || chr(39) || ', ' || chr(39) || 'phs000179' || chr(39) || ']' end as acl,
 'active' as type, '' as deletereason,
 case when k % 4 = 0 then 's3://ext/src/' || id || '/alt_' || cast(k as string)
      when k % 4 = 1 then null else 's3://ext/src/plain' end as url,
 o_orderpriority as priority
from (select o_orderkey as k, o_custkey, o_totalprice, o_orderstatus, o_orderpriority,
   substr(md5(cast(o_orderkey as string)),1,8) || '-' || substr(md5(cast(o_orderkey as string)),9,4) || '-' ||
   substr(md5(cast(o_orderkey as string)),13,4) || '-' || substr(md5(cast(o_orderkey as string)),17,4) || '-' ||
   substr(md5(cast(o_orderkey as string)),21,12) as id from {orders}) b
"""

# Unique on (bucket,key) after last-wins on seq; k%3=2 has nothing copied,
# except P2 in the flipped account.
FIXTURES["f_inventory_raw"] = """
select case when m.k % 3 = 0 then p.open_bucket else p.controlled_bucket end as bucket,
 m.id || '/' || m.file_name as key,
 case when m.k % 13 = 0 then m.size + 1 else m.size end as size,
 case when m.priority = '5-LOW' then 'STANDARD_IA' else 'STANDARD' end as storage_class,
 cast(1 as bigint) as seq
from {f_manifest} m join {f_project_buckets} p on m.project_id = p.project_id where m.k % 3 <> 2
union all
select case when m.k % 3 = 0 then p.open_bucket else p.controlled_bucket end, m.id || '/' || m.file_name,
 m.size + 7, 'INTELLIGENT_TIERING', cast(2 as bigint)
from {f_manifest} m join {f_project_buckets} p on m.project_id = p.project_id where m.k % 3 <> 2 and m.k % 17 = 0
union all
select 'gdc-ccle-2-controlled', m.id || '/' || m.file_name, m.size, 'STANDARD', cast(1 as bigint)
from {f_manifest} m where m.project_id = 'P2' and m.k % 3 = 2
"""

# Stored objects; those of doc_id % 17 = 0 are under another id.
FIXTURES["f_blobs"] = """
select case when doc_id % 17 = 0 then -1 - doc_id else doc_id end as blob_id, text from {documents}
"""

# Source-bucket listing; k%11 in (8,9,10) absent; k%11=2 has name+URL keys,
# k%11=3 URL+id keys.
FIXTURES["f_source"] = """
select id || '/' || file_name as key, size,
 case priority when '1-URGENT' then 'STANDARD' when '2-HIGH' then 'INTELLIGENT_TIERING' when '3-MEDIUM' then 'GLACIER'
  when '4-NOT SPECIFIED' then 'DEEP_ARCHIVE' else null end as storage_class
from {f_manifest} where k % 11 in (0,1,2,6,7)
union all
select id || '/alt_' || cast(k as string), size, 'GLACIER_IR' from {f_manifest} where k % 11 in (2,3) and k % 4 = 0
union all
select id, size, 'STANDARD' from {f_manifest} where k % 11 in (3,4,5)
"""

# Long form (did, pos, url); k%7=0 has no index record.
FIXTURES["f_index_urls"] = """
select m.id as did, 1 as pos, 'https://api.example.org/data/' || m.id as url from {f_manifest} m where m.k % 7 <> 0
union all
select m.id, 2, 's3://' || case when m.k % 3 = 0 then p.open_bucket else p.controlled_bucket end || '/' || m.id || '/' || m.file_name
from {f_manifest} m join {f_project_buckets} p on m.project_id = p.project_id where m.k % 7 <> 0 and m.k % 8 <> 0
union all
select m.id, 3, 'gs://' || g.gs_bucket_prefix || '-open/' || m.id || '/' || m.file_name
from {f_manifest} m join {f_project_map} g on m.project_id = g.project_id where m.k % 7 <> 0 and m.k % 9 <> 0
union all
select m.id, 4, 's3://gdc-ccle-2-controlled/' || m.id || '/' || m.file_name
from {f_manifest} m where m.k % 7 <> 0 and m.k % 16 = 0 and m.project_id = 'P2'
"""

# Scalar attributes of the index records of f_index_urls.
FIXTURES["f_index_attrs"] = """
select m.id as did, m.md5 as md5, m.size as size,
 case when m.k % 3 = 0 then '*' else 'phs000178' end as acl1,
 case when m.k % 3 = 0 then '/open' else '/programs/phs000178' end as authz1
from {f_manifest} m where m.k % 7 <> 0
"""

# GS listing uses the underscore name, k%10=0 absent; structured objects of
# f_ignored except k%93=0.
FIXTURES["f_gs_inventory"] = """
select g.gs_bucket_prefix || case when m.k % 2 = 0 then '-open' else '-controlled' end as bucket,
 m.id || '/' || replace(m.file_name, ' ', '_') as key, m.size as size
from {f_manifest} m join {f_project_map} g on m.project_id = g.project_id where m.k % 10 <> 0
union all
select g.gs_bucket_prefix || case when m.k % 2 = 0 then '-open' else '-controlled' end,
 'DIR' || cast(m.k % 4 as string) || '/x ' || cast(m.k as string) || '.bam', m.size
from {f_manifest} m join {f_project_map} g on m.project_id = g.project_id where m.k % 31 = 0 and m.k % 93 <> 0
"""

# What a listing run that failed on three buckets returns.
FIXTURES["f_listed"] = """
select bucket, key from (select bucket, key from {f_inventory_raw} union all select bucket, key from {f_gs_inventory}) t
where bucket not in ('gdc-cgci-phs000235-2-open', 'gdc-cgci-phs000235-controlled', 'gdc-varepop-apollo-phs001374-open')
"""

# Structured objects; k%62=0 lives on another host and must be filtered out.
FIXTURES["f_ignored"] = """
select id as gdc_uuid, size as gcs_object_size, '2016-03-28T21:51:54Z' as gcs_object_time_stamp, md5 as md5sum, 'phs000178' as acl,
 'gs://' || case when k % 62 = 0 then 'other_host' else '5aa919de-0aa0-43ec-9ec3-288481102b6d' end ||
 '/tcga/DIR' || cast(k % 4 as string) || '/x ' || cast(k as string) || '.bam' as gcs_object_url
from {f_manifest} where k % 31 = 0
"""

# Existing buckets; P7's controlled bucket is missing.
FIXTURES["f_buckets"] = """
select open_bucket as bucket from {f_project_buckets}
union select controlled_bucket from {f_project_buckets} where project_id <> 'P7'
"""

# Five updates for some records, told apart by bucket and ACL; the records of
# k % 3 = 0 are updated once and every one of their rows also hits one record.
FIXTURES["f_updates"] = """
select 8 * k as line_no, id, acl, md5, size, 's3://' || open_bucket || '/' || id as url
from {f_manifest} m join {f_project_buckets} p on m.project_id = p.project_id where k % 2 = 1
union all
select 8 * k + 1, id, acl, md5, size, 's3://' || controlled_bucket || '/' || id
from {f_manifest} m join {f_project_buckets} p on m.project_id = p.project_id where k % 4 = 1
union all
select 8 * k + 2, id, acl, md5, size, 'gs://other-open/' || id from {f_manifest} where k % 8 = 1
union all
select 8 * k + 3, 'hot', '[' || chr(39) || 'open' || chr(39) || ']', 'm', cast(7 as bigint),
 case when k % 5 = 0 then 's3://hot-open/x' when k % 7 = 0 then 's3://hot-2-controlled/y' else 'gs://hot-open/z' end
from {f_manifest}
"""

# File names that a careless writer or reader changes.
FIXTURES["f_names"] = """
select id, k, size, md5, case k % 6 when 0 then ' lead ' || cast(k as string) when 1 then 'trail ' || cast(k as string) || ' '
 when 2 then 'q"uote ' || cast(k as string) when 3 then 'tab' || chr(9) || cast(k as string) when 4 then '"' || cast(k as string) || '"'
 else 'back' || chr(92) || cast(k as string) end as file_name from {f_manifest}
"""

# Integrity check over real text.
FIXTURES["f_verify"] = """
select doc_id, case when doc_id % 11 = 0 then n_chars + 1 else n_chars end as size,
 case when doc_id % 7 = 0 then md5('x' || text) else md5(text) end as md5,
 case when doc_id % 17 = 0 then null else n_chars end as observed_size,
 case when doc_id % 13 = 0 then null else md5('etag' || cast(doc_id as string)) end as etag,
 md5(text) as observed_md5
from {documents}
"""


def _deps(text: str) -> list[str]:
    names = list(BASE_TABLES) + list(FIXTURES)
    return [n for n in names if "{" + n + "}" in text]


class Fixtures:
    """Fixture tables for one TESTDATA directory.

    Each derived table is computed by Spark once, written as parquet under
    the session's checkpoint folder (the shared folder of the cluster;
    a scratch folder only in local tests) and read back like any input
    table.  With ``materialize=False`` the tables stay lazy views.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark, self.sf_dir, self.materialize = spark, sf_dir, materialize
        self._cache: dict[str, DataFrame] = {}
        self._root = None
        self._lock = threading.RLock()  # fixtures derive from each other

    def _folder(self) -> str:
        if self._root is None:
            from objsync.session import ensure_checkpoint_dir
            self._root = os.path.join(ensure_checkpoint_dir(self.spark), f"objsync-fixtures-{uuid.uuid4().hex}")
        return self._root

    def table(self, name: str) -> DataFrame:
        with self._lock:
            return self._table(name)

    def _table(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        if name in BASE_TABLES:
            df = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        else:
            text = FIXTURES[name]
            df = self.spark.sql(text, **{d: self.table(d) for d in _deps(text)})
            if self.materialize:
                path = os.path.join(self._folder(), name)
                df.write.mode("overwrite").option("compression", "zstd").parquet(path)
                df = self.spark.read.parquet(path)
        self._cache[name] = df
        return df

    def unwritten(self, name: str) -> DataFrame:
        """A fixture for one reader that writes what it makes of it: not
        written itself (unless it is there already)."""
        with self._lock:
            if name in self._cache:
                return self._cache[name]
            return self.spark.sql(FIXTURES[name], **{d: self.table(d) for d in _deps(FIXTURES[name])})

    def derived(self, name: str, build) -> DataFrame:
        """An input table built by library code from other fixtures (e.g. an
        index snapshot assembled from its long-form export), materialized
        once like the SQL fixtures."""
        with self._lock:
            if name not in self._cache:
                df = build()
                if self.materialize:
                    path = os.path.join(self._folder(), name)
                    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
                    df = self.spark.read.parquet(path)
                    release_shuffles(self.spark)
                self._cache[name] = df
            return self._cache[name]

    def prepare(self, *names: str) -> None:
        """Derive (and write) the given fixtures, or all of them."""
        for n in names or FIXTURES:
            self.table(n)

    __getitem__ = table


def oracle_with(*names: str) -> str:
    """``WITH`` clause defining the given fixtures (and what they need) for
    DuckDB, where the base tables are registered views."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in order:
            return
        for d in _deps(FIXTURES[n]):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        body = FIXTURES[n].strip().format(**{d: d for d in _deps(FIXTURES[n])})
        parts.append(f"{n} as (\n{body}\n)")
    return "with " + ",\n".join(parts) + "\n"

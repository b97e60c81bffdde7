"""DuckDB oracle SQL for every registered query.

Written from the job semantics, independently of the Spark code; the only
shared text is the fixture derivation (``objsync.sources.fixtures``).
Base tables are the pre-registered TESTDATA views.
"""

from __future__ import annotations

from objsync import config as C
from objsync.config import PlanConfig
from objsync.sources.fixtures import oracle_with

API = PlanConfig().data_api_url


def _lst(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# Fixed values, spelled out apart from the library's own.
P1 = _lst(("gdc-cmi-mbc-phs001709", "gdc-cmi-asc-phs001931", "gdc-cmi-mpc-phs001939", "gdc-rebc-thyr-phs001134", "gdc-trio-cru-phs001163"))
P2 = _lst(("gdc-cgci-phs000235", "tcga", "gdc-organoid-pancreatic-phs001611", "gdc-beataml1-cohort-phs001657"))
COLD = _lst(("DEEP_ARCHIVE", "GLACIER", "GLACIER_IR"))
WS = r"'^\s+|\s+$'"


def drop_last(x: str, n: int) -> str:
    return f"substr({x}, 1, greatest(length({x}) - {n}, 0))"


def has(x: str, sub: str) -> str:
    return f"(strpos({x}, '{sub}') > 0)"


def aws_bucket_sql(prefix: str = "aws_bucket_prefix") -> str:
    return f"""case when {prefix} is null then null
 when {has(prefix, 'target')} then case when open2 then '{C.TARGET_OPEN_BUCKET}' else '{C.TARGET_CONTROLLED_BUCKET}' end
 when {has(prefix, 'tcga')} then case when open2 then '{C.TCGA_OPEN_BUCKET}' else '{C.TCGA_CONTROLLED_BUCKET}' end
 when {prefix} in ({P1}) then {prefix} || case when open3 then '-open' else '-controlled' end
 when {prefix} in ({P2}) then {prefix} || case when open3 then '-2-open' else '-2-controlled' end
 else {prefix} || case when open3 then '-2-open' else '-controlled' end end"""


def flip_sql(b: str) -> str:
    return f"""case when {has(b, '-2-controlled')} then {drop_last(b, 12)} || 'controlled'
 when {has(b, '-controlled')} then {drop_last(b, 10)} || '2-controlled'
 when {has(b, '-2-open')} then {drop_last(b, 6)} || 'open'
 when {has(b, '-open')} then {drop_last(b, 4)} || '2-open' end"""


def reverse_sql(b: str) -> str:
    stem_c = f"(case when {has(b, '-2-controlled')} then replace({b}, '-2-controlled', '') else replace({b}, '-controlled', '') end)"
    stem_o = f"(case when {has(b, '-2-open')} then replace({b}, '-2-open', '') else replace({b}, '-open', '') end)"
    return f"""case when {has(b, 'target')} then case when {has(b, 'open')} then '{C.TARGET_CONTROLLED_BUCKET}' else '{C.TARGET_OPEN_BUCKET}' end
 when {has(b, 'tcga')} then case when {has(b, 'open')} then {drop_last(b, 4)} || 'controlled' else {drop_last(b, 10)} || 'open' end
 when {has(b, 'controlled')} then case when {stem_c} in ({P1}) then {stem_c} || '-open' else {stem_c} || '-2-open' end
 when {has(b, 'open')} then case when {stem_o} in ({P2}) then {stem_o} || '-2-controlled' else {stem_o} || '-controlled' end end"""


def gs_reverse_sql(g: str, acl: str) -> str:
    return f"""case when {acl} is null then null when {has(acl, 'open')} then {drop_last(g, 5)} || '-controlled'
 else {drop_last(g, 11)} || '-open' end"""


URL_RE = r"'^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$'"
UUID_RE = "'" + C.UUID_TAIL_PATTERN + "'"


def pystrip(x: str) -> str:
    return f"regexp_replace({x}, {WS}, '', 'g')"


# Manifest joined with the project map, with the ACL readings used everywhere.
ROUTED = f"""routed as (
 select m.*, p.aws_bucket_prefix, p.gs_bucket_prefix, (p.project_id is not null) as known_project,
  coalesce(m.acl in ('[u''open'']', '[''open'']'), false) as open2,
  coalesce(m.acl in ('[u''open'']', '[''open'']', '*'), false) as open3
 from f_manifest m left join f_project_map p on m.project_id = p.project_id
),
routed2 as (
 select *, {aws_bucket_sql()} as target_bucket, id || '/' || file_name as object_key,
  gs_bucket_prefix || case when open3 then '-open' else '-controlled' end as gs_bucket,
  case when open2 then ['*'] else list_transform(
    string_split(substr({pystrip("coalesce(acl, '')")}, 2, greatest(length({pystrip("coalesce(acl, '')")}) - 2, 0)), ','),
    lambda x: replace(replace({pystrip('x')}, 'u''', ''), '''', '')) end as acl_lst
 from routed
),
r as (
 select *, case when open2 then ['/open'] else list_transform(acl_lst, lambda x: '/programs/' || x) end as authz_lst,
  len(list_filter(acl_lst, lambda x: not starts_with(x, 'phs'))) = 0 as acl_ok,
  list_filter(acl_lst, lambda x: not starts_with(x, 'phs'))[1] as first_bad
 from routed2
)"""

BAD_ACL_MSG = "'Only \"open\" and \"phs[...]\" ACLs are allowed. Got ACL \"' || first_bad || '\"'"

INV_DEDUP = """inv_all as (
 select bucket, key, arg_max(size, seq) as size, arg_max(storage_class, seq) as storage_class
 from f_inventory_raw group by bucket, key
)"""

EXPECTED = f"""expected as (
 select distinct provider, bucket from (
  select 'aws' as provider, case when {has('aws_bucket_prefix', 'target')} then '{C.TARGET_OPEN_BUCKET}'
    else aws_bucket_prefix || '-' || case when aws_bucket_prefix in ({P1}) then 'open' else '2-open' end end as bucket
  from f_project_map
  union all
  select 'aws', case when {has('aws_bucket_prefix', 'target')} then '{C.TARGET_CONTROLLED_BUCKET}'
    else aws_bucket_prefix || '-' || case when aws_bucket_prefix in ({P2}) then '2-controlled' else 'controlled' end end
  from f_project_map
  union all select 'gs', gs_bucket_prefix || '-open' from f_project_map
  union all select 'gs', gs_bucket_prefix || '-controlled' from f_project_map
 ) e
)"""

INV_AWS = "inv_aws as (select * from inv_all where bucket in (select bucket from expected where provider = 'aws'))"

IGNORED = f"""ig as (
 select gdc_uuid, gcs_object_url,
  case when len(list_filter(string_split(regexp_extract(gcs_object_url, {URL_RE}, 3), '/')[3:], lambda x: x <> '')) > 0
   then array_to_string(list_filter(string_split(regexp_extract(gcs_object_url, {URL_RE}, 3), '/')[3:], lambda x: x <> ''), '/')
  end as structured_key
 from f_ignored where regexp_extract(gcs_object_url, {URL_RE}, 2) = '{C.IGNORED_HOST}'
)"""

INDEX = """idx as (
 select a.did, coalesce(u.urls, []) as urls, [a.acl1] as acl, [a.authz1] as authz, a.md5, a.size
 from f_index_attrs a left join (select did, list(url order by pos) as urls from f_index_urls group by did) u
 on a.did = u.did
)"""


def repr_list(x: str) -> str:
    return f"case when len({x}) = 0 then '[]' else '[''' || array_to_string({x}, ''', ''') || ''']' end"


def w(*fixtures: str, extra: list[str] | None = None) -> str:
    head = oracle_with(*fixtures)
    if extra:
        head = head.rstrip() + ",\n" + ",\n".join(extra) + "\n"
    return head


MAN = ("f_manifest", "f_project_map")

AWS_PLAN = w(*MAN, "f_inventory_raw", "f_buckets", "f_source", extra=[ROUTED, INV_DEDUP, EXPECTED, INV_AWS, f"""
cands as (
 select line_no, 1 as pri, id || '/' || file_name as ck from f_manifest
 union all select line_no, 2, nullif(regexp_extract(url, {UUID_RE}, 0), '') from f_manifest
 union all select line_no, 3, id from f_manifest
),
best as (
 select c.line_no, min_by({{'k': c.ck, 'p': c.pri, 's': s.storage_class}}, c.pri) as b
 from cands c join f_source s on s.key = c.ck where c.ck is not null group by c.line_no
),
base as (
 select r.*, {reverse_sql('r.target_bucket')} as reversed_bucket,
  exists (select 1 from f_buckets bk where bk.bucket = r.target_bucket) as bucket_exists,
  exists (select 1 from inv_aws i where i.bucket = {reverse_sql('r.target_bucket')} and i.key = r.object_key) as moved,
  exists (select 1 from inv_aws i where i.bucket = r.target_bucket and i.key = r.object_key) as present,
  (select max(i.size) from inv_aws i where i.bucket = r.target_bucket and i.key = r.object_key) as tsize
 from r
),
pre as (
 select *, case when not known_project then 'REJECT' when not bucket_exists then 'REJECT' when moved then 'MOVE'
  when not present then 'SOURCE' else 'ALREADY_COPIED' end as act from base
),
plan as (
 select p.line_no, p.id, p.file_name, p.size, p.md5, p.acl, p.project_id, p.target_bucket, p.object_key,
  case when p.act = 'SOURCE' then b.b.k end as source_key,
  case when p.act = 'SOURCE' then b.b.p end as source_priority,
  case when p.act = 'SOURCE' and b.b.k is not null then coalesce(b.b.s, 'STANDARD') end as storage_class,
  case when p.act <> 'SOURCE' then p.act
   when b.b.k is null or coalesce(b.b.s, 'STANDARD') in ({COLD}) then 'STREAM' else 'COPY' end as action,
  case when p.act = 'MOVE' then 'AWS' when p.act = 'SOURCE' then
   case when b.b.k is null or coalesce(b.b.s, 'STANDARD') in ({COLD}) then 'GDCAPI' else 'AWS' end end as copy_method,
  case when p.act = 'MOVE' then true when p.act = 'SOURCE' then b.b.k is not null else false end as in_summary,
  (not p.present) or p.tsize <> p.size as needs_copy,
  case when not p.known_project then 'unknown_project' when not p.bucket_exists then 'no_bucket' end as reject_reason
 from pre p left join best b on p.line_no = b.line_no
)"""])

GS_PLAN_CTE = f"""
g as (
 select r.*, exists (select 1 from f_buckets bk where bk.bucket = r.gs_bucket) as bucket_exists,
  (ig.gdc_uuid is not null) as is_ignored, ig.structured_key, r.id || '/' || r.file_name as blob_name
 from r left join ig on ig.gdc_uuid = r.id
),
g2 as (
 select *, exists (select 1 from f_gs_inventory i where i.bucket = gs_bucket
    and i.key = case when is_ignored then structured_key else blob_name end) as listed_t,
  exists (select 1 from f_gs_inventory i where i.bucket = {gs_reverse_sql('gs_bucket', 'acl')} and i.key = blob_name) as listed_r
 from g
),
g3 as (
 select *, case when size = 0 then 'SKIP_EMPTY' when not known_project or not bucket_exists then 'REJECT'
  when is_ignored then 'INDEX_ONLY' when acl is null then 'ERROR' when listed_r then 'MOVE'
  when listed_t then 'ALREADY_COPIED' else 'STREAM' end as action
 from g2
),
gsplan as (
 select line_no, id, file_name, size, md5, acl, project_id, gs_bucket, blob_name, action,
  case when action = 'REJECT' then case when not known_project then 'unknown_project' else 'no_bucket' end end as reject_reason,
  action in ('MOVE', 'ALREADY_COPIED', 'STREAM') and (open2 or acl_ok) as copy_success,
  action in ('MOVE', 'ALREADY_COPIED', 'STREAM') and (open2 or acl_ok) as index_success,
  case when action = 'SKIP_EMPTY' then 'can not copy ' || id || ' to GOOGLE bucket since it is empty file'
   when not known_project then 'can not copy ' || id || ' to GOOGLE bucket. Detail project ' || coalesce(project_id, 'None') || ' is not in the project map'
   when action = 'REJECT' then 'There is no bucket with provided name ' || gs_bucket || chr(10)
   when action = 'INDEX_ONLY' and listed_t and not (open2 or acl_ok) then 'Internal error. Detail ' || {BAD_ACL_MSG}
   when action = 'INDEX_ONLY' then id || ' is in the ignored list'
   when action = 'ERROR' then 'Internal error. Detail acl is missing'
   when not (open2 or acl_ok) then 'Internal error. Detail ' || {BAD_ACL_MSG}
   else 'object ' || blob_name || ' successfully copied ' end as message,
  case when action = 'INDEX_ONLY' and listed_t and (open2 or acl_ok) then 'gs://' || gs_bucket || '/' || structured_key
   when action in ('MOVE', 'ALREADY_COPIED', 'STREAM') and (open2 or acl_ok) then 'gs://' || gs_bucket || '/' || blob_name
  end as index_url
 from g3
)"""

VALIDATE = w(*MAN, "f_inventory_raw", "f_gs_inventory", "f_ignored", "f_index_urls", "f_index_attrs",
             extra=[ROUTED, INV_DEDUP, IGNORED, INDEX, f"""
v0 as (
 select r.*, coalesce(idx.urls, []) as index_urls, coalesce({flip_sql('r.target_bucket')}, 'None') as flip,
  (ig.gdc_uuid is not null) as is_ignored, ig.structured_key
 from r left join idx on idx.did = r.id left join ig on ig.gdc_uuid = r.id
),
v1 as (
 select *, case when is_ignored then coalesce(structured_key, 'None') else id || '/' || replace(file_name, ' ', '_') end as gs_key,
  exists (select 1 from inv_all i where i.key = object_key and (i.bucket = target_bucket or i.bucket = flip)) as aws_present
 from v0
),
v2 as (
 select *, exists (select 1 from f_gs_inventory i where i.bucket = gs_bucket and i.key = gs_key) as gs_present from v1
),
v as (
 select cast(0 as integer) as manifest_no, line_no, id, file_name, md5, size, state, project_id, baseid, version, release,
  acl, type, deletereason, index_urls,
  len(index_urls) = 0 as no_index,
  case when known_project then not aws_present and size <> 0 end as aws_copy_fail,
  case when known_project then aws_present and size <> 0
   and not list_contains(index_urls, 's3://' || target_bucket || '/' || object_key)
   and not list_contains(index_urls, 's3://' || flip || '/' || object_key) end as aws_index_fail,
  case when known_project then not gs_present and size <> 0 end as gs_copy_fail,
  case when known_project then gs_present and size <> 0
   and not list_contains(index_urls, 'gs://' || gs_bucket || '/' || gs_key) end as gs_index_fail,
  case when known_project and aws_present and size <> 0 then 's3://' || flip || '/' || object_key end as aws_url,
  case when known_project and gs_present and size <> 0 then 'gs://' || gs_bucket || '/' || gs_key end as gs_url,
  {repr_list('index_urls')} as indexd_url,
  case when not known_project then 'unknown_project' end as reject_reason
 from v2
)"""])

REDACT = w(*MAN, "f_inventory_raw", "f_gs_inventory", "f_ignored", "f_index_urls", "f_index_attrs", extra=[ROUTED, INV_DEDUP, IGNORED, """
rd as (
 select r.*, r.id || '/' || r.file_name as k0, ig.gdc_uuid is not null as is_ignored, ig.structured_key
 from r left join ig on ig.gdc_uuid = r.id
),
s3log as (
 select line_no, id, 's3' as provider, case when known_project then 's3://' || target_bucket || '/' || k0 else k0 end as url,
  known_project and exists (select 1 from inv_all i where i.bucket = target_bucket and i.key = k0) as deleted,
  case when not known_project then 'project ' || coalesce(project_id, 'None') || ' is not in the project map' end as message
 from rd
),
gslog0 as (
 select *, coalesce(case when is_ignored then structured_key end, k0) as gkey from rd
),
gslog as (
 select line_no, id, 'gs' as provider, case when known_project then 'gs://' || gs_bucket || '/' || gkey else k0 end as url,
  known_project and exists (select 1 from f_gs_inventory i where i.bucket = gs_bucket and i.key = gkey) as deleted,
  case when not known_project then 'project ' || coalesce(project_id, 'None') || ' is not in the project map'
   when not exists (select 1 from f_gs_inventory i where i.bucket = gs_bucket and i.key = gkey)
   then 'No such object: ' || gs_bucket || '/' || gkey end as message
 from gslog0
),
rlog as (
 select line_no, id, provider, url, deleted, deleted as "indexdUpdated", message from s3log
 union all
 select line_no, id, provider, url, deleted, deleted, message from gslog
)"""])

# P22 over unnested URLs: removable = same scheme and (special pair or same
# stem); inside a run of consecutive removable URLs only every other one
# (starting with the first) is examined and removed.
INDEX_MERGE = w(*MAN, "f_index_urls", "f_index_attrs", extra=[ROUTED, INDEX, f"""
upd as (
 select id as did, 's3://' || target_bucket || '/' || object_key as url, acl_lst, authz_lst, md5, size
 from r where known_project and target_bucket is not null and (open2 or acl_ok)
),
j as (
 select x.did, x.urls, x.acl, x.authz, u.url as new_url, u.acl_lst, u.authz_lst,
  list_contains(x.urls, u.url) as present
 from idx x join upd u on x.did = u.did
),
el as (
 select did, new_url, unnest(urls) as e, generate_subscripts(urls, 1) as i from j where not present
),
el2 as (
 select *, lower(regexp_extract(new_url, {URL_RE}, 1)) = lower(regexp_extract(e, {URL_RE}, 1)) and (
   (regexp_extract(new_url, {URL_RE}, 2) = 'ccle-open-access' and regexp_extract(e, {URL_RE}, 2) = 'gdc-ccle-controlled')
   or (regexp_extract(new_url, {URL_RE}, 2) = 'gdc-ccle-controlled' and regexp_extract(e, {URL_RE}, 2) = 'ccle-open-access')
   or (case when ends_with(regexp_extract(new_url, {URL_RE}, 2), '-open') then {drop_last(f"regexp_extract(new_url, {URL_RE}, 2)", 5)}
        else {drop_last(f"regexp_extract(new_url, {URL_RE}, 2)", 11)} end)
    = (case when ends_with(regexp_extract(e, {URL_RE}, 2), '-open') then {drop_last(f"regexp_extract(e, {URL_RE}, 2)", 5)}
        else {drop_last(f"regexp_extract(e, {URL_RE}, 2)", 11)} end)) as rm
 from el
),
el3 as (
 select *, i - row_number() over (partition by did, rm order by i) as grp from el2
),
el4 as (
 select *, rm and ((row_number() over (partition by did, rm, grp order by i)) - 1) % 2 = 0 as removed from el3
),
kept as (
 select did, list(e order by i) filter (where not removed) as kept_urls,
  list(e order by e) filter (where not removed) as kept_sorted
 from el4 group by did
),
merged as (
 select j.did,
  case when j.present then j.urls else coalesce(k.kept_urls, []) || [j.new_url] end as urls,
  case when j.present then list_sort(j.urls) else coalesce(k.kept_sorted, []) end as meta_keys,
  case when list_sort(list_distinct(j.acl)) = list_sort(list_distinct(j.acl_lst)) then j.acl else j.acl_lst end as acl,
  case when list_sort(list_distinct(j.authz)) = list_sort(list_distinct(j.authz_lst)) then j.authz else j.authz_lst end as authz,
  case when not j.present or list_sort(list_distinct(j.acl)) <> list_sort(list_distinct(j.acl_lst))
   or list_sort(list_distinct(j.authz)) <> list_sort(list_distinct(j.authz_lst)) then 'patched' else 'unchanged' end as change
 from j left join kept k on j.did = k.did
),
final as (
 select m.did, m.urls, m.meta_keys, m.acl, m.authz, x.md5, x.size, m.change from merged m join idx x on m.did = x.did
 union all
 select x.did, x.urls, list_sort(x.urls), x.acl, x.authz, x.md5, x.size, 'untouched' from idx x
 where not exists (select 1 from upd u where u.did = x.did)
 union all
 select u.did, ['{API}' || u.did, u.url], [], u.acl_lst, u.authz_lst, u.md5, coalesce(u.size, 0), 'created'
 from upd u where not exists (select 1 from idx x where x.did = u.did)
)"""])


def _q(head: str, body: str) -> str:
    return head + body.strip() + "\n"


ROUTE = w(*MAN, extra=[ROUTED])
GS_PLAN = w(*MAN, "f_buckets", "f_gs_inventory", "f_ignored", extra=[ROUTED, IGNORED, GS_PLAN_CTE.strip()])
PIPE = w(*MAN, "f_gs_inventory", extra=[ROUTED, EXPECTED, """
gsinv as (select * from f_gs_inventory where bucket in (select bucket from expected where provider = 'gs')),
pipe as (
 select line_no, id, replace(file_name, ' ', '_') as file_name, size, md5, replace(acl, ' ', '') as acl, project_id
 from r where not exists (select 1 from gsinv g where g.bucket = r.gs_bucket and g.key = r.id || '/' || r.file_name)
)"""])

ORACLE: dict[str, str] = {}

ORACLE["copy_totals"] = _q(w(*MAN, "f_inventory_raw", extra=[ROUTED, INV_DEDUP, EXPECTED, INV_AWS]), """
select target_bucket, count(*) as n_files, cast(sum(r.size) as bigint) as total_bytes,
 cast(sum(r.size) as double) / 1073741824.0 as total_gib
from r left join inv_aws i on i.bucket = r.target_bucket and i.key = r.object_key
where i.key is null or i.size <> r.size
group by target_bucket
""")

ORACLE["route_aws"] = _q(ROUTE, "select line_no, id, project_id, acl, target_bucket from r")
ORACLE["route_gs"] = _q(ROUTE, "select line_no, id, project_id, acl, gs_bucket from r")
ORACLE["flip"] = _q(ROUTE, f"select line_no, target_bucket, {flip_sql('target_bucket')} as flipped from r")
ORACLE["reverse"] = _q(ROUTE, f"select line_no, target_bucket, {reverse_sql('target_bucket')} as reversed from r")
ORACLE["gs_reverse"] = _q(ROUTE, f"select line_no, gs_bucket, acl, {gs_reverse_sql('gs_bucket', 'acl')} as gs_reversed from r")
ORACLE["expected_buckets"] = _q(w("f_project_map", extra=[EXPECTED]), "select provider, bucket from expected")
ORACLE["missing_buckets"] = _q(w("f_project_map", "f_listed", extra=[EXPECTED]), """
select provider, bucket from expected e
where not exists (select 1 from f_listed i where i.bucket = e.bucket)
""")
ORACLE["parse_urls"] = f"""
select page_id, lower(regexp_extract(url, {URL_RE}, 1)) as scheme, regexp_extract(url, {URL_RE}, 2) as netloc,
 regexp_extract(url, {URL_RE}, 3) as path, regexp_replace(regexp_extract(url, {URL_RE}, 4), '^\\?', '') as query,
 regexp_replace(regexp_extract(url, {URL_RE}, 5), '^#', '') as fragment
from pages
"""
ORACLE["structured_key"] = _q(w("f_manifest", "f_ignored", extra=[IGNORED]), "select gdc_uuid, structured_key from ig")
ORACLE["url_source_key"] = _q(w("f_manifest"),
                              f"select line_no, url, nullif(regexp_extract(url, {UUID_RE}, 0), '') as url_key from f_manifest")
ORACLE["acl_parse"] = _q(ROUTE, """
select line_no, acl, array_to_string(acl_lst, '|') as acl_list, array_to_string(authz_lst, '|') as authz_list,
 open2 or acl_ok as acl_ok from r
""")
_CH = 8 * 1024 * 1024
ORACLE["chunk_plan"] = _q(w("f_manifest"), f"""
select id, size, cast(s // {_CH} + 1 as integer) as part_number, s as start_byte,
 least(s + {_CH - 1}, size - 1) as end_byte, least(s + {_CH - 1}, size - 1) - s + 1 as part_size
from (select id, size, unnest(generate_series(0, size - 1, {_CH})) as s from f_manifest where size > 0) t
""")
ORACLE["to_copy"] = _q(w(*MAN, "f_inventory_raw", extra=[ROUTED, INV_DEDUP, EXPECTED, INV_AWS]), """
select r.line_no, r.id, r.target_bucket, r.size
from r left join inv_aws i on i.bucket = r.target_bucket and i.key = r.object_key
where i.key is null or i.size <> r.size
""")
ORACLE["pipeline_manifest"] = _q(PIPE, "select * from pipe")
ORACLE["source_key"] = _q(w("f_manifest", "f_source", extra=[f"""
cands as (
 select line_no, 1 as pri, id || '/' || file_name as ck from f_manifest
 union all select line_no, 2, nullif(regexp_extract(url, {UUID_RE}, 0), '') from f_manifest
 union all select line_no, 3, id from f_manifest
),
best as (
 select c.line_no, min_by({{'k': c.ck, 'p': c.pri, 's': s.storage_class}}, c.pri) as b
 from cands c join f_source s on s.key = c.ck where c.ck is not null group by c.line_no
)"""]), """
select m.line_no, b.b.k as source_key, b.b.p as source_priority, b.b.s as source_storage_class
from f_manifest m left join best b on m.line_no = b.line_no
""")
ORACLE["copy_plan_aws"] = _q(AWS_PLAN, "select * from plan")
ORACLE["copy_summary"] = _q(AWS_PLAN.rstrip() + ",\n" + """
cat as (
 select case when not in_summary then (case when copy_method = 'GDCAPI' then 'STREAM_NOT_COUNTED' end)
  when copy_method = 'GDCAPI' then 'GDCAPI'
  when coalesce(storage_class = 'INTELLIGENT_TIERING', false) then 'AWS_INTELLIGENT_TIERING'
  else 'AWS_OTHER' end as category, size from plan
)
""", """
select v.category, coalesce(a.n, 0) as n_files, coalesce(a.b, 0) as total_bytes,
 cast(coalesce(a.b, 0) as double) / 1073741824.0 as total_gib
from (values ('GDCAPI'), ('AWS_INTELLIGENT_TIERING'), ('AWS_OTHER'), ('STREAM_NOT_COUNTED')) v(category)
left join (select category, count(*) as n, cast(sum(size) as bigint) as b from cat group by category) a
 on a.category = v.category
""")
ORACLE["copy_plan_gs"] = _q(GS_PLAN, "select * from gsplan")

_FMT_GS = GS_PLAN_CTE.replace("from r left join ig on ig.gdc_uuid = r.id", "from pr r left join ig on ig.gdc_uuid = r.id")
ORACLE["format_result"] = _q(
    w(*MAN, "f_buckets", "f_gs_inventory", "f_ignored", extra=[ROUTED, EXPECTED, IGNORED, """
gsinv as (select * from f_gs_inventory where bucket in (select bucket from expected where provider = 'gs')),
pipe as (
 select line_no, id, replace(file_name, ' ', '_') as file_name, size, md5, replace(acl, ' ', '') as acl, project_id
 from r where not exists (select 1 from gsinv g where g.bucket = r.gs_bucket and g.key = r.id || '/' || r.file_name)
),""" + ROUTED.replace("routed as (", "p_routed as (", 1).replace("from routed\n", "from p_routed\n", 1)
        .replace("from f_manifest m", "from pipe m", 1).replace("routed2 as (", "p_routed2 as (", 1)
        .replace("from routed2", "from p_routed2", 1).replace("\nr as (", "\npr as (", 1), _FMT_GS.strip()]), """
select line_no, id, concat_ws(chr(9), coalesce(id, 'None'), coalesce(file_name, 'None'), cast(size as varchar),
 coalesce(md5, 'None'), coalesce(acl, 'None'), coalesce(project_id, 'None'),
 case when copy_success then 'True' else 'False' end, case when index_success then 'True' else 'False' end,
 coalesce(message, 'None')) as line
from gsplan
""")

_NO_FLAG = "cast(null as boolean)"
ORACLE["validate_aws"] = _q(VALIDATE, f"""
select line_no, id, no_index, aws_copy_fail, aws_index_fail, {_NO_FLAG} as gs_copy_fail, {_NO_FLAG} as gs_index_fail from v
""")
ORACLE["validate_gs"] = _q(VALIDATE, f"""
select line_no, id, no_index, {_NO_FLAG} as aws_copy_fail, {_NO_FLAG} as aws_index_fail, gs_copy_fail, gs_index_fail from v
""")
ORACLE["result_log_round_trip"] = _q(GS_PLAN, """
select id, concat_ws(chr(9), coalesce(id, 'None'), coalesce(replace(file_name, ' ', '_'), 'None'), cast(size as varchar),
 coalesce(md5, 'None'), coalesce(acl, 'None'), coalesce(project_id, 'None'),
 case when copy_success then 'True' else 'False' end, case when index_success then 'True' else 'False' end,
 coalesce(message, 'None')) as line, 'r1' as release
from gsplan
""")
ORACLE["manifest_round_trip"] = _q(w("f_names"), """
select row_number() over (order by id) - 1 as line_no, id, file_name, size, md5 from f_names
""")
ORACLE["index_assemble"] = _q(w("f_index_urls", "f_index_attrs", extra=[INDEX]), """
select did, array_to_string(urls, '|') as urls, array_to_string(list_sort(urls), '|') as meta_keys,
 array_to_string(acl, '|') as acl, array_to_string(authz, '|') as authz, md5, size from idx
""")
ORACLE["validate_rows"] = _q(VALIDATE, """
select manifest_no, line_no, id, no_index, aws_copy_fail, aws_index_fail, gs_copy_fail, gs_index_fail, aws_url, gs_url,
 indexd_url, reject_reason from v
""")


def _flag(c: str) -> str:
    return f"cast(sum(case when coalesce({c}, false) then 1 else 0 end) as bigint)"


ORACLE["validate_counts"] = _q(VALIDATE, f"""
select manifest_no, aws_copy_failures, aws_index_failures, gs_copy_failures, gs_index_failures, n_rows,
 aws_copy_failures + aws_index_failures + gs_copy_failures + gs_index_failures = 0 as passed
from (select manifest_no, {_flag('aws_copy_fail')} as aws_copy_failures,
  {_flag('no_index')} + {_flag('aws_index_fail')} as aws_index_failures,
  {_flag('gs_copy_fail')} as gs_copy_failures,
  {_flag('no_index')} + {_flag('gs_index_fail')} as gs_index_failures,
  count(*) as n_rows from v group by manifest_no) t
""")
ORACLE["validate_fail_list"] = _q(VALIDATE, """
select manifest_no, line_no, 1 as check_no, 'no_index_record' as reason, id, aws_url, gs_url, indexd_url from v where no_index
union all select manifest_no, line_no, 2, 'aws_copy', id, aws_url, gs_url, indexd_url from v where coalesce(aws_copy_fail, false)
union all select manifest_no, line_no, 2, 'aws_index', id, aws_url, gs_url, indexd_url from v where coalesce(aws_index_fail, false)
union all select manifest_no, line_no, 3, 'gs_copy', id, aws_url, gs_url, indexd_url from v where coalesce(gs_copy_fail, false)
union all select manifest_no, line_no, 3, 'gs_index', id, aws_url, gs_url, indexd_url from v where coalesce(gs_index_fail, false)
""")
ORACLE["augmented_manifest"] = _q(VALIDATE, """
select manifest_no, line_no, id, file_name, md5, size, state, project_id, baseid, version, release, acl, type,
 deletereason, gs_url, indexd_url, cast(null as varchar) as case_submitter_ids
from v where size <> 0
""")
ORACLE["index_merge"] = _q(INDEX_MERGE, """
select did, array_to_string(urls, '|') as urls, array_to_string(meta_keys, '|') as meta_keys,
 array_to_string(acl, '|') as acl, array_to_string(authz, '|') as authz, md5, size, change from final
""")
ORACLE["redaction_plan"] = _q(REDACT, "select * from rlog")
ORACLE["redaction_summary"] = _q(REDACT, """
select 's3' as provider, cast(sum(case when deleted then 1 else 0 end) as bigint) as deleted, count(*) as total
from s3log
union all select 'gs', cast(0 as bigint), cast(0 as bigint)
""")
ORACLE["index_remove_url"] = _q(REDACT.rstrip() + ",\n" + INDEX + ",\n" + """
rm as (select id as did, list(distinct url) as urls from rlog where "indexdUpdated" group by id)
""", """
select x.did,
 array_to_string(case when rm.did is null then x.urls else list_filter(x.urls, lambda u: not list_contains(rm.urls, u)) end, '|') as urls,
 array_to_string(list_sort(case when rm.did is null then x.urls else list_filter(x.urls, lambda u: not list_contains(rm.urls, u)) end), '|') as meta_keys,
 array_to_string(x.acl, '|') as acl, array_to_string(x.authz, '|') as authz, x.md5, x.size,
 rm.did is not null as updated
from idx x left join rm on rm.did = x.did
""")
ORACLE["index_delete"] = _q(w(*MAN, "f_index_attrs", extra=[ROUTED]), """
select a.did from f_index_attrs a where not exists (select 1 from r where r.known_project and r.id = a.did)
""")
ORACLE["index_missing"] = _q(w("f_manifest", "f_index_attrs"), """
select m.line_no, m.id from f_manifest m where not exists (select 1 from f_index_attrs a where a.did = m.id)
""")
ORACLE["indexing_status"] = _q(w(*MAN, "f_inventory_raw", extra=[ROUTED, INV_DEDUP]), f"""
select line_no, id, object_key as object_path, target_bucket, copied as copy_success,
 copied and (open2 or acl_ok) as index_success,
 case when copied and not (open2 or acl_ok) then {BAD_ACL_MSG} end as msg
from (select *, known_project and exists (select 1 from inv_all i where i.bucket = target_bucket and i.key = object_key)
  as copied from r) t
""")
ORACLE["md5_hex"] = """
select doc_id, to_base64(unhex(md5(text))) as md5_base64, lower(hex(from_base64(to_base64(unhex(md5(text)))))) as md5_hex,
 lower(hex(from_base64(to_base64(unhex(md5(text)))))) = md5(text) as matches
from documents
"""
ORACLE["verify_objects"] = _q(w("f_verify"), """
select v.doc_id as id, cast(length(d.text) as bigint) as received_size, md5(d.text) as content_md5,
 case when not coalesce(cast(length(d.text) as bigint) = v.size, false) then 'size_received'
  when v.observed_size is null then 'no_object'
  when v.observed_size <> v.size then 'size_stored'
  when v.etag is null then 'no_etag'
  when not coalesce(md5(d.text) = v.md5, false) then 'md5' else 'ok' end as result,
 (case when not coalesce(cast(length(d.text) as bigint) = v.size, false) then 'size_received'
  when v.observed_size is null then 'no_object'
  when v.observed_size <> v.size then 'size_stored'
  when v.etag is null then 'no_etag'
  when not coalesce(md5(d.text) = v.md5, false) then 'md5' else 'ok' end) = 'ok' as passed
from f_verify v left join documents d on d.doc_id = v.doc_id
""")
ORACLE["inventory_last_wins"] = _q(w("f_manifest", "f_project_buckets", "f_inventory_raw", extra=[INV_DEDUP]),
                                   "select bucket, key, size, storage_class from inv_all")
# Positions [1000, 5000) of the orders file in file order.  The TESTDATA
# orders files are stored in o_orderkey order (checked against DuckDB's
# file_row_number at every scale factor), which makes the oracle's order
# deterministic; the Spark query numbers rows by file position only.
ORACLE["row_slice"] = """
select line_no, o_orderkey, o_custkey from (
 select row_number() over (order by o_orderkey) - 1 as line_no, o_orderkey, o_custkey from orders) t
where line_no >= 1000 and line_no < 5000
"""
ORACLE["group_complete"] = _q(w(*MAN, "f_gs_inventory", extra=[ROUTED]), """
select cast(floor(line_no / 100) as bigint) as chunk_id, count(*) as n_files,
 bool_and(not known_project or exists (select 1 from f_gs_inventory g where g.bucket = r.gs_bucket
   and g.key = r.id || '/' || r.file_name)) as complete
from r group by 1
""")

ORACLE["received_bytes"] = _q(w("f_manifest"), f"""
select id, cast(sum(least(s + {_CH - 1}, size - 1) - s + 1) as bigint) as received_size
from (select id, size, unnest(generate_series(0, size - 1, {_CH})) as s from f_manifest where size > 0) t
group by id
""")
ORACLE["gs_blob_checks"] = _q(w("f_verify", "f_blobs"), """
select v.doc_id as id, d.blob_id is not null as exists,
 d.blob_id is not null and coalesce(cast(length(d.text) as bigint) = v.size and md5(d.text) = v.md5, false)
  as exists_and_match,
 d.blob_id is not null and coalesce(md5(d.text) <> v.md5, false) as resumable_copy_failed
from f_verify v left join f_blobs d on d.blob_id = v.doc_id
""")
# C3 -> C6: URLs produced by the GS copy plan merged into the index.
INDEX_MERGE_GS = w(*MAN, "f_buckets", "f_gs_inventory", "f_ignored", "f_index_urls", "f_index_attrs",
                   extra=[ROUTED, IGNORED, GS_PLAN_CTE.strip(), INDEX]).rstrip() + ",\n" + \
    INDEX_MERGE[INDEX_MERGE.index("upd as ("):].replace(
        """upd as (
 select id as did, 's3://' || target_bucket || '/' || object_key as url, acl_lst, authz_lst, md5, size
 from r where known_project and target_bucket is not null and (open2 or acl_ok)
)""", """upd as (
 select p.id as did, p.index_url as url, r.acl_lst, r.authz_lst, p.md5, p.size
 from gsplan p join r on r.line_no = p.line_no where p.index_url is not null and (r.open2 or r.acl_ok)
)""")
ORACLE["index_merge_gs"] = _q(INDEX_MERGE_GS, """
select did, array_to_string(urls, '|') as urls, array_to_string(meta_keys, '|') as meta_keys,
 array_to_string(acl, '|') as acl, array_to_string(authz, '|') as authz, md5, size, change from final
""")

ORACLE["copy_counters"] = _q(AWS_PLAN, """
select cast(sum(case when action in ('MOVE', 'COPY', 'ALREADY_COPIED') or (action = 'STREAM' and in_summary)
  then 1 else 0 end) as bigint) as processed_files,
 cast(sum(case when action in ('MOVE', 'COPY', 'ALREADY_COPIED') or (action = 'STREAM' and in_summary)
  then size else 0 end) as bigint) as processed_bytes,
 count(*) as total_files,
 cast(sum(case when action in ('MOVE', 'COPY', 'ALREADY_COPIED') or (action = 'STREAM' and in_summary)
  then size else 0 end) as double) / 1073741824.0 as processed_gib
from plan
""")


def _stem_sql(b: str) -> str:
    return f"case when ends_with({b}, '-open') then {drop_last(b, 5)} else {drop_last(b, 11)} end"


def _same_project_sql(x: str, y: str) -> str:
    bx, by = (f"regexp_extract({v}, {URL_RE}, 2)" for v in (x, y))
    pair = "['ccle-open-access', 'gdc-ccle-controlled']"
    return f"""(lower(regexp_extract({x}, {URL_RE}, 1)) = lower(regexp_extract({y}, {URL_RE}, 1)) and
  ({_stem_sql(bx)} = {_stem_sql(by)} or ({bx} <> {by} and list_contains({pair}, {bx}) and list_contains({pair}, {by}))))"""


_SWEEP = f"""list_reduce(a.urls, lambda k, e: case when not k.skip and {_same_project_sql('u.url', 'e')}
   then {{'kept': k.kept, 'gone': list_append(k.gone, e), 'skip': true}}
   else {{'kept': list_append(k.kept, e), 'gone': k.gone, 'skip': false}} end,
  {{'kept': []::varchar[], 'gone': []::varchar[], 'skip': false}})"""
_SAME_SET = "list_sort(list_distinct({})) = list_sort(list_distinct({}))"
# Every update of a record applied in order, one after another.
ORACLE["index_merge_multi"] = _q(w("f_updates", "f_index_urls", "f_index_attrs", extra=[INDEX, f"""
read1 as (
 select *, coalesce(acl in ('[u''open'']', '[''open'']'), false) as open2 from f_updates
),
read2 as (
 select *, case when open2 then ['*'] else list_transform(
   string_split(substr({pystrip("coalesce(acl, '')")}, 2, greatest(length({pystrip("coalesce(acl, '')")}) - 2, 0)), ','),
   lambda x: replace(replace({pystrip('x')}, 'u''', ''), '''', '')) end as acl_lst from read1
),
ups as (
 select id as did, arg_min(md5, line_no) as md5, arg_min(coalesce(size, 0), line_no) as size,
  list({{'url': url, 'acl': acl_lst,
   'authz': case when open2 then ['/open'] else list_transform(acl_lst, lambda x: '/programs/' || x) end}} order by line_no) as ups
 from read2 where open2 or len(list_filter(acl_lst, lambda x: not starts_with(x, 'phs'))) = 0 group by id
),
begun as (
 select coalesce(x.did, n.did) as did, x.did is not null as old, n.did is not null as touched, coalesce(n.ups, []) as ups,
  case when x.did is null then ['{API}' || n.did, n.ups[1].url] else x.urls end as urls0,
  case when x.did is null then n.ups[1].acl else x.acl end as acl0,
  case when x.did is null then n.ups[1].authz else x.authz end as authz0,
  coalesce(x.md5, n.md5) as md5, coalesce(x.size, n.size) as size
 from idx x full join ups n on x.did = n.did
),
ended as (
 select *, list_reduce(ups, lambda a, u: {{
   'urls': case when list_contains(a.urls, u.url) then a.urls else list_append({_SWEEP}.kept, u.url) end,
   'gone': case when list_contains(a.urls, u.url) then a.gone else list_distinct(list_concat(a.gone, {_SWEEP}.gone)) end,
   'acl': case when {_SAME_SET.format('a.acl', 'u.acl')} then a.acl else u.acl end,
   'authz': case when {_SAME_SET.format('a.authz', 'u.authz')} then a.authz else u.authz end,
   'changed': a.changed or not list_contains(a.urls, u.url) or not ({_SAME_SET.format('a.acl', 'u.acl')})
     or not ({_SAME_SET.format('a.authz', 'u.authz')})}},
  {{'urls': urls0, 'gone': []::varchar[], 'acl': acl0, 'authz': authz0, 'changed': false}}) as z
 from begun
)"""]), """
select did, array_to_string(z.urls, '|') as urls,
 array_to_string(case when old then list_sort(list_filter(urls0, lambda x: not list_contains(z.gone, x))) else [] end, '|') as meta_keys,
 array_to_string(z.acl, '|') as acl, array_to_string(z.authz, '|') as authz, md5, size,
 case when not touched then 'untouched' when not old then 'created' when z.changed then 'patched' else 'unchanged' end as change
from ended
""")

ORACLE["inventory_json_round_trip"] = _q(w("f_manifest", "f_project_buckets", "f_inventory_raw", extra=[INV_DEDUP]),
                                         "select bucket, key, size, storage_class from inv_all")
ORACLE["gs_inventory_json"] = _q(w("f_manifest", "f_project_map", "f_gs_inventory", extra=[EXPECTED]), """
select bucket, key, cast(size as bigint) as size from f_gs_inventory where bucket in (select bucket from expected where provider = 'gs')
""")
ORACLE["project_map_json"] = _q(w("f_project_map"), "select project_id, aws_bucket_prefix, gs_bucket_prefix from f_project_map")
_INDEX_TEXT = """select did, array_to_string(urls, '|') as urls, array_to_string(list_sort(urls), '|') as meta_keys, {acl} as acl, {authz} as authz,
 {md5} as md5, {size} as size from idx"""
ORACLE["index_map_json"] = _q(w("f_index_urls", "f_index_attrs", extra=[INDEX]),
                              _INDEX_TEXT.format(acl="''", authz="''", md5="cast(null as varchar)", size="cast(null as bigint)"))
ORACLE["index_snapshot_round_trip"] = _q(w("f_index_urls", "f_index_attrs", extra=[INDEX]), _INDEX_TEXT.format(
    acl="array_to_string(acl, '|')", authz="array_to_string(authz, '|')", md5="md5", size="size"))
ORACLE["pipeline_manifest_round_trip"] = _q(w("f_manifest"), """
select id, replace(file_name, ' ', '_') as file_name, size, md5, replace(acl, ' ', '') as acl, project_id from f_manifest where acl is not null
""")
ORACLE["deletion_log_round_trip"] = _q(REDACT, """
select 'r1' as release, provider, url, deleted, "indexdUpdated", message from rlog
""")
ORACLE["lookup_later_wins"] = _q(REDACT.rstrip() + ",\n" + INDEX + ",\n" + """
rm as (select id as did, list(distinct url) as gone from rlog where "indexdUpdated" group by id),
x as (
 select idx.did, m.k, array_to_string(idx.urls, '|') as before,
  array_to_string(list_filter(idx.urls, lambda u: not list_contains(coalesce(rm.gone, []), u)), '|') as after
 from idx join f_manifest m on m.id = idx.did left join rm on rm.did = idx.did
)""", "select did, case when k % 2 = 0 then after else before end as urls from x where k % 3 <> 0 or k % 2 = 0")
for _scope, _provider in (("s3", "s3"), ("aws", "s3"), ("gs", "gs")):
    ORACLE[f"redaction_plan_{_scope}"] = _q(REDACT, f"select * from rlog where provider = '{_provider}'")
_RUN = VALIDATE.rstrip() + """,
tagged as (
 select v.* replace (cast(case when v.no_index or v.aws_copy_fail or v.aws_index_fail or v.gs_copy_fail or v.gs_index_fail then f.k % 2 else 2 end as integer) as manifest_no)
 from v join f_manifest f on f.line_no = v.line_no
),
per as (
 select manifest_no, """ + f"""{_flag('aws_copy_fail')} as aws_copy_failures, {_flag('no_index')} + {_flag('aws_index_fail')} as aws_index_failures,
  {_flag('gs_copy_fail')} as gs_copy_failures, {_flag('no_index')} + {_flag('gs_index_fail')} as gs_index_failures, count(*) as n_rows
 from tagged group by manifest_no
),
judged as (select *, aws_copy_failures + aws_index_failures + gs_copy_failures + gs_index_failures = 0 as passed from per)
"""
ORACLE["validate_run"] = _q(_RUN, """
select *, case when passed then 'manifest' else 'FAIL_manifest' end as output, 'manifest' as forced_output from judged
union all select null, cast(sum(aws_copy_failures) as bigint), cast(sum(aws_index_failures) as bigint), cast(sum(gs_copy_failures) as bigint),
 cast(sum(gs_index_failures) as bigint), cast(sum(n_rows) as bigint), bool_and(passed), null, null from judged
""")
ORACLE["validation_reports"] = _q(_RUN, """
select 'manifest' as kind, t.manifest_no, t.id, t.size, t.gs_url, t.indexd_url from tagged t join judged j on j.manifest_no = t.manifest_no
where j.passed and t.size <> 0
union all
select 'FAIL_manifest', t.manifest_no, t.id, t.size, t.gs_url, t.indexd_url from tagged t join judged j on j.manifest_no = t.manifest_no,
 unnest([t.no_index, t.aws_copy_fail, t.aws_index_fail, t.gs_copy_fail, t.gs_index_fail]) as c(failed)
where not j.passed and coalesce(failed, false)
""")
ORACLE["shuffled_rows"] = _q(w("f_manifest"), """
select line_no, id, row_number() over (order by md5('42:' || cast(line_no as varchar)), line_no) - 1 as rand_pos from f_manifest
""")
ORACLE["part_digests"] = """
with b as (select doc_id as id, encode(text) as c, octet_length(encode(text)) as n from documents),
p as (
 select id, n, i + 1 as part_number, md5(c[i * 1000 + 1 : (i + 1) * 1000]) as part_md5 from b, unnest(range(0, (n + 999) // 1000)) as u(i)
)
select id, cast(count(*) as integer) as n_parts, any_value(n) as received_size, true as complete,
 md5(unhex(string_agg(part_md5, '' order by part_number))) || '-' || count(*) as multipart_etag,
 string_agg(part_md5, ',' order by part_number) as part_md5s
from p group by id
"""
ORACLE["index_table_merge"] = ORACLE["index_merge_multi"].replace(
    " md5, size,\n case when not touched then 'untouched' when not old then 'created' when z.changed then 'patched' else 'unchanged' end as change\n",
    " md5, size\n")

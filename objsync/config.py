"""Fixed values and run parameters.

Everything under "FIXED VALUES" must equal the values of the replication
jobs we reproduce, otherwise bucket routing and index records come out
different.  Everything else is a parameter with a default.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the replication jobs we reproduce)
# ---------------------------------------------------------------------------

# ACL text that means "open" for target routing, tcga routing and index ACLs.
OPEN_ACL_2 = ("[u'open']", "['open']")
# ACL text that means "open" for the other routing branches (adds "*").
OPEN_ACL_3 = ("[u'open']", "['open']", "*")

# Bucket prefixes whose buckets end in -open / -controlled.
POSTFIX_1_EXCEPTION = (
    "gdc-cmi-mbc-phs001709",
    "gdc-cmi-asc-phs001931",
    "gdc-cmi-mpc-phs001939",
    "gdc-rebc-thyr-phs001134",
    "gdc-trio-cru-phs001163",
)
# Bucket prefixes whose buckets end in -2-open / -2-controlled.
POSTFIX_2_EXCEPTION = (
    "gdc-cgci-phs000235",
    "tcga",
    "gdc-organoid-pancreatic-phs001611",
    "gdc-beataml1-cohort-phs001657",
)

# Fixed AWS buckets of the "target" and "tcga" programs.
TARGET_OPEN_BUCKET = "gdc-target-phs000218-2-open"
TARGET_CONTROLLED_BUCKET = "target-controlled"
TCGA_OPEN_BUCKET = "tcga-2-open"
TCGA_CONTROLLED_BUCKET = "tcga-2-controlled"

# The bucket pair that counts as "same project" when replacing index URLs.
SPECIAL_URL_BUCKET_PAIR = ("ccle-open-access", "gdc-ccle-controlled")

# Host of the structured ("ignored") objects.
IGNORED_HOST = "5aa919de-0aa0-43ec-9ec3-288481102b6d"

# Source storage classes that cannot be copied server side.
COLD_STORAGE_CLASSES = ("DEEP_ARCHIVE", "GLACIER", "GLACIER_IR")
# Storage class reported when the listing/HEAD omits it.
DEFAULT_STORAGE_CLASS = "STANDARD"
INTELLIGENT_TIERING = "INTELLIGENT_TIERING"

# Copy methods of a plan, and the categories of the dry-run summary.
STREAM_METHOD = "GDCAPI"
SERVER_METHOD = "AWS"

# Regular expression of a lower-case UUID followed by the rest of a URL.
UUID_TAIL_PATTERN = (
    "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}.*$"
)

# Column order of the release manifest header.
MANIFEST_COLUMNS = (
    "id", "file_name", "md5", "size", "state", "project_id", "baseid",
    "version", "release", "acl", "type", "deletereason", "url",
)
# Column order of the whitespace separated pipeline manifest.
PIPELINE_COLUMNS = ("id", "file_name", "size", "md5", "acl", "project_id")
# Column order of the augmented (validated) manifest.
AUGMENTED_COLUMNS = (
    "id", "file_name", "md5", "size", "state", "project_id", "baseid",
    "version", "release", "acl", "type", "deletereason", "gs_url",
    "indexd_url", "case_submitter_ids",
)

# Field names of the redaction (deletion) log records.
DELETION_LOG_FIELDS = ("url", "deleted", "indexdUpdated", "message")

# Default multipart chunk (bytes) of a streamed copy.
DEFAULT_CHUNK_BYTES = 1024 * 1024 * 128

GIB = 1024 * 1024 * 1024

# ---------------------------------------------------------------------------
# Run parameters
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class PlanConfig:
    """Parameters of the plan builders.

    ``on_unknown_project``: ``"reject"`` keeps the row and sets
    ``reject_reason='unknown_project'``; ``"fail"`` aborts the job when a row
    has a project missing from the map.  ``spread_hot_keys``: into so many
    parts the rows of a frequent manifest key are dealt for an inventory
    probe (0: not at all).
    """

    on_unknown_project: str = "reject"
    data_api_url: str = "https://api.example.org/data/"
    auth_namespace: str = ""
    dedupe_inventory: bool = True
    platform: str = "ALL"  # validation: AWS | GS | ALL
    redact_scope: str = "all"  # redaction: all | s3 | aws | gs
    dry_run: bool = True
    force_manifest: bool = False
    spread_hot_keys: int = 0

    def namespace(self) -> str:
        ns = self.auth_namespace.strip("/")
        return "/" + ns if ns else ""

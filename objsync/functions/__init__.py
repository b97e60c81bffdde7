"""Column -> Column building blocks (routing, URLs, ACLs, object scalars)."""

from objsync.functions.acl import (  # noqa: F401
    acl_list, acl_valid, authz_list, bad_acl_message, py_list_repr, py_strip, same_set,
)
from objsync.functions.objects import (  # noqa: F401
    chunk_ranges, gib, md5_base64, md5_hex_from_base64, py_bool_text, py_text,
)
from objsync.functions.routing import (  # noqa: F401
    aws_bucket, aws_expected_buckets, aws_reversed_bucket, bucket_project_stem,
    flip_account, gs_bucket, gs_expected_buckets, gs_reversed_bucket, is_open_2, is_open_3,
)
from objsync.functions.urls import (  # noqa: F401
    compact_acl, object_key, provider_url, safe_name, structured_key, url_fragment,
    url_netloc, url_path, url_query, url_scheme, uuid_tail_key,
)

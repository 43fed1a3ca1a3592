from issuerlake.streaming.jobs import (  # noqa: F401
    compact_catalog, compact_sums, stream_gold_refresh, stream_ingest, stream_matched_requests, stream_request_log,
    stream_request_sessions,
)
from issuerlake.streaming.replays import (  # noqa: F401
    stream_documents_requested, stream_gold_from_statements, stream_ingest_documents, stream_request_windows,
    stream_sessions_of_requests, stream_sliding_requests,
)

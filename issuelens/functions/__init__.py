"""Column expressions (all built-in Spark functions, codegen-friendly)."""

from issuelens.functions.jsonpath import json_text, ISSUE_PATHS  # noqa: F401
from issuelens.functions.text import (  # noqa: F401
    issue_key_in, strip_quotes, join_chain, or_empty)
from issuelens.functions.timefmt import (  # noqa: F401
    parse_iso_utc, parse_jira_ts, try_parse_iso_utc, epoch_seconds_between,
    iso_z, minute_text, truncate_minute, as_of_lit, days_before)

"""Fixed parameters of the registered queries (the values the reference
passes as literals: one issue key, one PR number, watermarks, as-of times)."""

SINGLE_ISSUE = "PROJ-7"                      # Q5: one issue's status pivot
PR_NUMBER = 123                              # Q6: commits of one PR
RECENT_AS_OF = "2023-12-20 00:00:00"         # Q7: now()
RECENT_DAYS = 7
NEWER_THAN = "2001-01-01 00:00:00"           # FLT-1 watermark
SINCE = "2023-12-15 10:30:45"                # FLT-3 watermark (truncated to the minute)
STRAY_LINE = 3                               # DQ-2: commits of this line name a PR that does not exist
UPSERT_TARGET_BEFORE = "1998-01-01 00:00:00" # UPS: table holds commits shipped before …
UPSERT_SOURCE_FROM = "1997-01-01 00:00:00"   # … and the batch those shipped from here on
UPSERT_KEEP = ["author_name", "author_date"] # columns kept from the existing row
BAD_DATE_FLAG = ("R", "F")                   # landed commits with this flag/status carry d/m/Y dates
NO_ITEMS_EVERY = 50                          # changelog entries with id % 50 == 0 have no items
NO_AUTHOR_EVERY = 7                          # … with id % 7 == 0 have no author
RUN_SPLITS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")  # incremental runs split events by ts
PAGE_SIZE = 50                               # PRs of one landed page
CUT_PAGES = (7, 3)                           # pages with page % 7 == 3 are cut off …
REPAIRED_PAGES = (14, 3)                     # … and those with page % 14 == 3 land again whole
CUT_PERCENT = 60                             # what is left of a cut page's characters
BULK_BUCKETS = 8                             # buckets of the bulk merge's table
MEMBER_KINDS = 3                             # event_id % 3: from values missing (0), null (1), present (2)
CUT_RECORD_EVERY = 40                        # changelog records with event_id % 40 == 0 are cut off
SQL_STATUSES = ("view", "it's \"closed\"; --", "purchase")  # statuses asked for in SQL
OTHER_PROJECT_EVERY = 7                      # issues that another project has too
RELANDED = 10                                # every 10th key lands again in a later run

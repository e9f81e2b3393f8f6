"""Names, labels, formats and thresholds that results must agree on."""

# --- fixed values -------------------------------------------------------------------------

# keys every event object must carry
REQUIRED_FIELDS = ["id", "type", "actor", "repo", "created_at"]

# event types and their descriptions
EVENT_DESCRIPTIONS = {
    "PushEvent": "Code push to repository",
    "PullRequestEvent": "Pull request opened/closed/reopened",
    "IssuesEvent": "Issue opened/closed/reopened",
    "IssueCommentEvent": "Comment added to issue/PR",
    "WatchEvent": "User starred repository",
    "ForkEvent": "Repository forked",
    "CreateEvent": "Branch or tag created",
    "DeleteEvent": "Branch or tag deleted",
    "MemberEvent": "Collaborator added",
    "ReleaseEvent": "Release published",
    "PullRequestReviewEvent": "PR review submitted",
}
OTHER_DESCRIPTION = "Other event type"
EVENT_TYPES = list(EVENT_DESCRIPTIONS)

# event categories
EVENT_CATEGORIES = {
    "Activity": ["PushEvent", "PullRequestEvent", "IssuesEvent"],
    "Repository Management": ["CreateEvent", "DeleteEvent"],
    "Engagement": ["WatchEvent", "ForkEvent"],
    "Collaboration": ["MemberEvent", "ReleaseEvent"],
}
OTHER_CATEGORY = "Other"

ACTOR_TYPES = ["User", "Bot"]
LOAD_STATUSES = ["SUCCESS", "FAILED", "SKIPPED", "RETRY"]

# substrings (case-insensitive) that mark bots and trial repositories
BOT_PATTERN = "%bot%"
TEST_REPO_PATTERNS = ["%test%", "%example%"]

# placeholder hashed in place of a NULL key column (public definition of the key macro)
NULL_KEY = "_dbt_utils_surrogate_key_null_"

# far end of an open validity interval, start of time for an empty high-water mark
OPEN_END = "2099-12-31 00:00:00"
BEGIN_OF_TIME = "1900-01-01 00:00:00"

# hourly file name: the hour is not zero-padded
HOUR_FORMAT = "yyyy-MM-dd-H"
FILE_SUFFIX = ".json.gz"
FILE_NAME_PATTERN = r"(\d{4}-\d{2}-\d{2}-\d{1,2}\.json\.gz)"

ERROR_MESSAGE_CHARS = 1000

# freshness tiers in hours: below the bound the tier applies
FRESHNESS_TIERS = [("FRESH", 1), ("OK", 2), ("WARN", 4)]
STALE_TIER = "STALE"

# metric, warning bound, error bound (a value at or above the bound gets the grade)
GRADE_BOUNDS = [
    ("data_freshness_hours", 2.0, 4.0),
    ("consecutive_load_failures", 1.0, 3.0),
    ("duplicate_events", 1.0, 1.0),
    ("missing_dimension_percent", 1.0, 5.0),
    ("test_failures", 1.0, 1.0),
]
# --- end of fixed values ------------------------------------------------------------------

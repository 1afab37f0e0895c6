"""Parameters of the registered queries, shared with their SQL."""

ENDPOINT = "https://bars.example/v1/bars"
AS_OF = "2001-08-02"
WORKERS = 16
MORE_ROWS_THAN = 530
BUDGET_MB = 1.0
HISTORY_END = "2000-01-01"
NEW_TICKER = "5-LOW"
RANGE_START, RANGE_END = "1999-03-06", "2000-03-04"
PERIODS = [("slump", "1997-08-01", "1998-12-31"), ("recovery", "2000-01-01", "2001-06-30")]
GAP_EVERY = 97
EMPTY_ANSWER = '{"ticker":"%s-%d","data":[]}'
LANDINGS = 3
LATENESS = "4 days"

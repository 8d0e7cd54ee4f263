"""The registered queries, each with the SQL that checks it where there is one."""

from lakepnl.queries import contracts, lake, landing, marts, run_state

MODULES = (lake, marts, contracts, landing, run_state)

"""threadkeeper: keep a document index in step with a forum of posts and comments.

Every phase is a set-based DataFrame transformation over (state, observation)
tables.  Nothing loops over rows on the driver; the run time is an explicit
parameter so every result is deterministic.
"""

from threadkeeper.params import SyncParams

__all__ = ["SyncParams"]

"""ratewise: collaborative-filtering recommendations as Spark jobs.

Ratings come in from files or a stream, live in keyed Parquet tables with
last-write-wins upserts, are factorised with alternating least squares
(Spark ML's count-weighted form, or an exact plain-ridge form built from
joins, grouped sums and a batched solve), scored, and published as the top
items per user.
"""

from ratewise.session import build_session, checkpoint_root, scratch_path, ship_package

__all__ = ["build_session", "checkpoint_root", "scratch_path", "ship_package"]

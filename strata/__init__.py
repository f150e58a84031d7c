"""strata — tiered document-graph analytics as Spark DataFrame jobs.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL expressions; Python runs only inside Arrow-batched seams
(Office parsing, numpy top-k, PCA projection).
"""

from strata.session import build_session, cut_lineage, ensure_checkpoint_dir

__all__ = ["build_session", "cut_lineage", "ensure_checkpoint_dir"]

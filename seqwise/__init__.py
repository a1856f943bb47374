"""seqwise: ordered event tables on Spark.

As-of cumulative rates, shrinkage priors, group fills, rule splits, fit/apply
encoders, sequence windows and next-event classifiers, all expressed with the
DataFrame API so Catalyst and AQE plan the work.
"""

from seqwise.config import EventConfig
from seqwise.session import get_spark, checkpoint_dir

__all__ = ["EventConfig", "get_spark", "checkpoint_dir"]

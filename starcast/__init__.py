"""starcast — star-rating prediction features and models as Spark jobs.

Every public function takes and returns lazy DataFrames (or Spark ML
models); nothing gathers rows on the driver except bounded metadata
(the feature vocabulary, min/max rows and network weights).
"""

from starcast.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]

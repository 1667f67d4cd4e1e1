"""Population analytics on longitudinal patient records, written as Spark DataFrame transformations."""

from cohortry.session import build_session, configure, materialize, release_scratch, shared_folder

__all__ = ["build_session", "configure", "materialize", "release_scratch", "shared_folder"]

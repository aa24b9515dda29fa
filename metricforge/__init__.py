"""metricforge: reusable Spark DataFrame operators and a catalogue of
business metrics (product, economy, market, cleaning, profiling) built
from them.

Every operator is a ``DataFrame -> DataFrame`` (or ``Column``) function made
of built-in Spark SQL expressions, so Catalyst can push filters and prune
columns into the scan and whole-stage codegen keeps the work in the JVM.
"""

from metricforge.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]

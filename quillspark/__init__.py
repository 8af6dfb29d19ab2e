"""quillspark: record-to-search-document sync expressed as Spark DataFrame operators.

Every public function takes and returns ``DataFrame`` or ``Column`` objects; the
logical plan is built lazily and Catalyst picks the physical strategy.
"""

from quillspark.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]

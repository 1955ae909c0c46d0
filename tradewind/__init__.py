"""tradewind — a PySpark-native marketplace analytics engine.

Staging with a data-quality gate, four analytical marts, a star schema and the
dashboard measures over them, all expressed as DataFrame plans that Catalyst
optimises and Spark runs in parallel.
"""

from tradewind.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]

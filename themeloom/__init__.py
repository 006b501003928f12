"""themeloom: feedback-to-decision analytics as PySpark DataFrame operators."""

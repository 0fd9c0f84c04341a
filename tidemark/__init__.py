"""Spark-native market analytics: options chains, price bars, regimes, events and trades."""

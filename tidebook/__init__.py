"""Market-snapshot analytics on Spark: snapshot change capture, history import, log analytics."""

"""Trade and quote analytics on Spark: Bronze, Silver, Gold, bars, marts, streams."""

"""Scenario mining over multi-actor time series, as DataFrame plans."""

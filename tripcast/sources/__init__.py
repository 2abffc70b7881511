"""Sources and sinks: raw trip CSVs, weather, holidays, addresses, fixture views, writers."""

"""Sources and sinks: filtered table scans, snapshots, models and result bundles."""

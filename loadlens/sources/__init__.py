"""Sources and sinks: the driver's tables, run-table views, run store IO."""

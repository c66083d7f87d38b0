"""Sources and sinks: driver-table adapters, feed readers, stored tables."""

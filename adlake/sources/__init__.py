"""Sources and sinks: driver-table adapter, strict CSV readers, layered tables, event logs."""

"""Tables in and out: scans, incremental loads, sinks."""

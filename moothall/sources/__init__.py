"""Sources and sinks: captured pages, documents on disk, queues, reports."""

"""Sources and sinks: typed tables, storage listings, packet files and bucketed target tables."""

"""Jobs that combine operators with reads and writes."""

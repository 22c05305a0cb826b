"""Sources and sinks: drops, intake texts, archives, stored tables and results."""

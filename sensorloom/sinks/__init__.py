"""Writers: tables with month partitions, feature facts, CSV, JSON."""

"""DataFrame operators; all of them are lazy and keyed by device."""

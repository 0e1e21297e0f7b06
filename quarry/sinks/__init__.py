"""Report sinks: dated report tables, export packages, manifests."""

"""Writers: products, packed records, provenance, state snapshots."""

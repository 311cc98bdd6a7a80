"""Tables in and out: workspace, snapshots, keyed tables, CSV and split-aware reads, run log."""

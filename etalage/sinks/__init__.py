"""Writers: warehouse tables with a load journal, rejects, partitioned facts, raw copies."""

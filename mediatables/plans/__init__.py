"""Query surface (C3/C6), batch jobs (C1-C9) and the stand-in queries on the shared tables."""

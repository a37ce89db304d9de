"""Writers: files by layer, versioned tables, audit rows, upserts, JDBC."""

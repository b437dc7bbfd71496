"""Writers: report directories, CSV, partitioned fan-out, JDBC, preview."""

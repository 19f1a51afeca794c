"""Writers: CSV, JDBC, staging and the versioned table store."""

"""Reading and writing files, lake tables and JDBC tables."""

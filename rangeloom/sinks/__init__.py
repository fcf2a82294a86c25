"""Writers: lake folders, JDBC tables, key-value layouts."""

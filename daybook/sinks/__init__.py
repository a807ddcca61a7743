"""Writers: CSV and delimited files, the target table, a database table."""

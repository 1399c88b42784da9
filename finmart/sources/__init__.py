"""Where data comes from and goes to: sessions, lake zones, JDBC, generated feeds."""

"""The derived city over the driver tables, its queries and the SQL they are held against."""

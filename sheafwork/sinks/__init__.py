"""Writers: layer tables, partitioned output, file layout and views."""

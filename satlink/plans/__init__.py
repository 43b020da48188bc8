"""Plans: snapshot store, warehouse build order, registered queries and their SQL."""

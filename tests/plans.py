"""What ran: the metrics of every node of an executed plan."""

WANTED = ("numFiles", "numOutputRows", "shuffleRecordsWritten", "filesSize")


def metrics(df):
    """Runs ``df`` and lists ``name``, ``text`` and metrics of its nodes, subqueries left out."""
    df.collect()
    found = []

    def visit(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return visit(node.executedPlan())
        if "QueryStage" in name:
            return visit(node.plan())
        own = node.metrics()
        found.append({"name": name, "text": node.simpleString(2000) + " " + node.output().toString()}
                     | {k: own.apply(k).value() for k in WANTED if own.contains(k)})
        children = node.children().iterator()
        while children.hasNext():
            visit(children.next())

    visit(df._jdf.queryExecution().executedPlan())
    return found
